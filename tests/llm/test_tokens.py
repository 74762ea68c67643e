import io
import random
import zlib

from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortforge.llm import bpe, grammar
from cohortforge.llm.chunks import PIECES, ChunkMemory, cut

ALPHABET = [
    "a", "the", " ", "  ", "\n", " \n", "\t", "'s", "'ll", "9", "é", "日本", "<|endoftext|>", "😀",
    "\xa0", "　", "\x85", "\x1c", "!!", "_", "A", " b", "\r\n", "İ", "​",
]
TEXTS = st.lists(st.sampled_from(ALPHABET), max_size=14).map("".join)


@pytest.fixture(scope="session")
def library(tokenizer_path):
    tokenizer = Tokenizer.from_file(tokenizer_path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="session")
def own(tokenizer_path):
    return bpe.Bpe(tokenizer_path)


@pytest.fixture(scope="session")
def encoder(tokenizer_path):
    return grammar.LibraryEncoder(tokenizer_path)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_encodes_as_the_library(library, own, encoder, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == ids
    assert encoder.encode([text])[0].tolist() == ids
    assert own.decode(own.encode([text])[0]) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "the", " ", "\n", "  ", ",", "\n ", " b\n"]), max_size=8).map("".join), max_size=12))
def test_texts_encoded_together_do_not_touch(library, encoder, texts):
    found = [ids.tolist() for ids in encoder.encode(texts)]
    assert found == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_the_library_gets_words_in_short_texts(library, tokenizer_path, monkeypatch):
    """It takes longer for a word in a text of thousands, and for a text of one word."""
    encoder, given = grammar.LibraryEncoder(tokenizer_path), []
    whole = encoder.whole
    monkeypatch.setattr(encoder, "whole", lambda texts: (given.extend(texts), whole(texts))[1])
    texts = [f"'s{k}\n, first {k}é of. {k}\n these{k}," for k in range(1500)]
    found = encoder.encode(texts)
    assert [f.tolist() for f in found] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert max(len(t.split()) for t in given) <= 200 and len(given) < len(texts) / 10


def test_each_chunk_is_encoded_once_and_kept_for_two_generations():
    encoded = []
    memory = ChunkMemory(lambda chunks: (encoded.extend(chunks), [c.encode() for c in chunks])[1], kept=10)
    for k in range(200):
        chunks = [f"{k}-{j}" for j in range(7)] + ["same"]
        assert memory.each(chunks) == [c.encode() for c in chunks]
        assert len(memory.new) <= 18 and len(memory.old) <= 18
    assert memory.each([]) == [] and len(encoded) == 7 * 200 + 1


def test_lengths_of_rules_that_refer_to_others():
    rules = np.array([[0, 1], [5, 2], [5, 5], [6, 7], [3, 3], [8, 9]])
    assert grammar.lengths_of(rules, 5).tolist() == [2, 3, 4, 7, 2, 9]
    assert grammar.lengths_of(rules[:0], 5).tolist() == []


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "!" * 999, " " * 3000, "é" * 999, "theonand" * 500])
def test_long_words(library, own, text):
    assert np.frombuffer(own.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_chunks_join_to_the_text_and_cut_between_pieces(text):
    chunks = cut(text)
    assert "".join(chunks) == text
    assert [p for c in chunks for p in PIECES.findall(c)] == PIECES.findall(text)


def test_memory_is_bounded():
    memory = ChunkMemory(lambda chunks: [c.encode() for c in chunks], kept=10)
    for k in range(200):
        chunks = [f"{k}-{j}" for j in range(7)] + ["same"]
        memory.learn(set(chunks))
        assert memory.ids(chunks) == "".join(chunks).encode()
        assert len(memory.new) <= 18 and len(memory.old) <= 18


def expected(library, rows):
    out, start = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_edge_rows(library, edges, nothing, tokenizer_path):
    rows = [tuple(r) for r in edges.select("doc_id", "text").collect()]
    found = bpe.round_trip(edges, tokenizer_path).collect()
    assert len(found) == len(rows) and all(r["exact"] for r in found)
    sizes = sorted((r["doc_id"] or 0, r["n_tokens"]) for r in found)
    assert sizes == sorted((d or 0, len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)
    assert bpe.round_trip(nothing, tokenizer_path).collect() == []
    decoded = bpe.decode(bpe.encode(edges, tokenizer_path), tokenizer_path).select("text", "decoded", "score").collect()
    assert all((r["text"] or "") == r["decoded"] and r["score"] == "mine" for r in decoded)


def test_shards_of_edge_rows(library, edges, nothing, tokenizer_path):
    rows = [tuple(r) for r in edges.select("doc_id", "text").collect()]
    found = grammar.write_and_read(edges, tokenizer_path).collect()
    key = lambda r: tuple(-(10**9) if x is None else x for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(expected(library, rows), key=key)
    assert grammar.write_and_read(nothing, tokenizer_path).collect() == []


def test_shards_of_a_table(spark, library, sf_dir, tokenizer_path, monkeypatch):
    monkeypatch.setattr(grammar, "SHARD", 20_000)  # several shards a partition
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    manifest = grammar.write(docs, tokenizer_path)
    assert sorted(tuple(r) for r in grammar.read(manifest).collect()) == expected(library, rows)
    ids = {r["doc_id"]: r["ids"] for r in grammar.read(manifest, ids=True).collect()}
    assert all(zlib.crc32(ids[d]) == crc for d, _, _, crc in expected(library, rows))


def test_grammar_random_access():
    rng = random.Random(2)
    for _ in range(30):
        docs = [[rng.choice([1, 1, 1, 2, 3]) for _ in range(rng.randint(0, 900))] + [0] for _ in range(rng.randint(1, 8))]
        raw = [np.array(d, "<u4") for d in docs]
        file = io.BytesIO()
        grammar.write_shard(file, list(range(len(docs))), raw, 50)
        shard = grammar.Shard(file.getvalue())
        for k, doc in enumerate(docs):
            assert shard.document(k).tolist() == doc
            a = rng.randint(0, len(doc))
            b = rng.randint(a, len(doc))
            assert shard.token_range(k, a, b).tolist() == doc[a:b]
    assert len(shard.symbols) < sum(map(len, docs)) or sum(map(len, docs)) < 500


def pairs_within(symbols, starts):
    """Occurrences of each pair within documents."""
    ends = set(starts[1:].tolist())
    return Counter((a, b) for k, (a, b) in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist())) if k + 1 not in ends)


def plain_repair(docs, terminals, least):
    """Re-Pair one pair at a time, all counts anew each time; the symbols and rules left."""
    docs, rules = [list(d) for d in docs], 0
    while True:
        counts = Counter(p for d in docs for p in zip(d, d[1:]))
        pair, n = max(counts.items(), key=lambda x: x[1], default=(None, 0))
        if n < least:
            return sum(map(len, docs)), rules
        new, rules = terminals + rules, rules + 1
        for d in docs:
            k = 0
            while k + 1 < len(d):
                if (d[k], d[k + 1]) == pair:
                    d[k : k + 2] = [new]
                k += 1


def test_grammar_goes_on_until_no_pair_is_frequent(monkeypatch):
    """Nearly as small as Re-Pair that takes one pair at a time, and no frequent pair is left."""
    random.seed(4)
    monkeypatch.setattr(grammar, "BINS", 64)  # many pairs share a bin
    monkeypatch.setattr(grammar, "FREQUENT", 8)
    phrases = [[random.randrange(40) for _ in range(random.randint(2, 30))] for _ in range(25)]
    docs = [[t for _ in range(random.randint(0, 30)) for t in random.choice(phrases)] + [0] for _ in range(60)]
    ids = np.array(sum(docs, []), np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    symbols, at, rules = grammar.compress(ids, starts, 50)
    assert max(pairs_within(symbols, at).values()) < 8
    left, plain_rules = plain_repair(docs, 50, 8)
    assert len(symbols) + 2 * len(rules) <= 1.1 * (left + 2 * plain_rules)
    assert grammar.lengths_of(rules, 50).max() > 16
    file = io.BytesIO()
    grammar.write_shard(file, list(range(len(docs))), [np.array(d, np.uint32) for d in docs], 50)
    shard = grammar.Shard(file.getvalue())
    assert [shard.document(k).tolist() for k in range(len(docs))] == docs


def test_grammar_compresses_repeats():
    ids = np.array([5, 6, 7, 8] * 5000, np.uint32)
    symbols, starts, rules = grammar.compress(ids, np.array([0, len(ids)]), 50)
    assert len(symbols) <= len(ids) / 8 and starts.tolist() == [0, len(symbols)]
    assert grammar.lengths_of(rules, 50).max() >= 8
    with pytest.raises(ValueError):
        grammar.Shard(b"something else")
