"""Token ids in Re-Pair grammar files: compressed per shard, with random access to any token range.

Pairs of adjacent symbols that occur often in a shard are replaced by nonterminals, round after
round, until no pair does; a round replaces all frequent pairs at once, the more frequent first
where they overlap. A shard file holds the rules, the length each expands to, and the symbols of each document.
No rule reaches over the end of a document.

File: `MAGIC`; four little-endian 64-bit counts (documents, rules, symbols, terminals); then
little-endian arrays: doc_id (int64, with a mask byte for null), first symbol of each document
(int64, and the end), left and right symbol of each rule (uint32), its length (int64), and the
symbols, three bytes each. Rule k is symbol `terminals + k`.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortforge.llm.chunks import ChunkMemory, clean_spaces
from cohortforge.llm.shared import kept_by_worker, new_path, staged, text_slices

MAGIC = b"repair01"
END = 0  # the id that ends a document
SHARD = 1_500_000  # tokens after which a shard is closed; a document is never split
FREQUENT = 64  # occurrences from which a pair is replaced
TOGETHER = 100  # words joined for a call of the library, which takes a half longer for each in texts of thousands
BINS = 20  # bits of the hash bins that pairs are counted in, at most
SLICE = 8 << 20  # bytes of text whose distinct chunks are encoded together


class LibraryEncoder:
    """Ids of texts by the tokenizers library, each distinct chunk of a batch of texts once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size()
        # a letter of the vocabulary is a byte
        self.lengths = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)], np.int64)
        self.memory = ChunkMemory(self.words)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, straight from the library."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4") for e in found]

    def words(self, words: list[str], before: str = " ") -> list[bytes]:
        """The ids of words, each with a space (or a line feed) before it, as bytes.

        Joined, they encode as they do alone: the library never lets a piece run across a space
        between two other characters, nor across one line feed. Where a word's ids end follows from
        their lengths in bytes.
        """
        parts = (before + before.join(words[at : at + TOGETHER]) for at in range(0, len(words), TOGETHER))
        ids = np.concatenate([np.empty(0, "<u4"), *(self.whole([part])[0] for part in parts)])
        sizes = pc.binary_length(pa.array(words, pa.large_string())).to_numpy().astype(np.int64)
        places = np.searchsorted(np.cumsum(self.lengths[ids]), np.cumsum(sizes + 1)) + 1
        data, ends = ids.tobytes(), (4 * places).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def alone(self, words: list[str]) -> list[bytes]:
        """The ids of words with nothing before them. A line feed, of one id, sets them apart where it can."""
        plain = [bool(w) and not w[0].isspace() and not w[-1].isspace() for w in words]
        others = iter(self.whole([w for w, p in zip(words, plain) if not p]))
        mine = iter(self.words([w for w, p in zip(words, plain) if p], "\n"))
        return [next(mine)[4:] if p else next(others).tobytes() for p in plain]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """All ids of each text. Texts with other white space, or special tokens, go to the library whole."""
        texts = [t or "" for t in texts]
        plain = [clean_spaces(t) and not any(s in t for s in self.special) for t in texts]
        others = iter(self.whole([t for t, p in zip(texts, plain) if not p]))
        parts = pc.split_pattern(pa.array([t for t, p in zip(texts, plain) if p], pa.large_string()), " ")
        mine = iter(self.of_words(parts.offsets.to_numpy(), parts.values))
        return [next(mine if p else others) for p in plain]

    def of_words(self, starts: np.ndarray, words: pa.Array) -> Iterator[np.ndarray]:
        """Ids of texts that have been split at spaces: the first word of each has none before it."""
        if len(starts) < 2:
            return
        coded = words.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        # no word holds a space: one text for all of them is cut faster than each is copied
        together = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        distinct = pc.binary_join(together, pa.scalar(" ", pa.large_string()))[0].as_py().split(" ")
        first = starts[:-1]
        alone = self.alone(words.take(pa.array(first)).to_pylist())
        # only the first word of a text can be empty or start with a line feed
        later = [w for w in distinct if w and w[0] != "\n"]
        known = iter(self.memory.each(later))
        known = [*(next(known) if w and w[0] != "\n" else b"" for w in distinct), *alone]
        which[first] = len(distinct) + np.arange(len(first))
        taken = pa.array(known, pa.large_binary()).take(pa.array(which))
        ends = np.frombuffer(taken.buffers()[1], np.int64, len(taken) + 1) // 4
        ids = np.frombuffer(taken.buffers()[2] or b"", "<u4", int(ends[-1]))
        bounds = ends[starts].tolist()
        yield from (ids[a:b] for a, b in zip(bounds, bounds[1:]))


def winners(close: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Of pairs in order, those replaced: no two overlap, lower ranks first.

    `close` says of each but the last whether the next begins with its second symbol. In a run of
    one pair, as in aaaa, every other one is replaced.
    """
    none = np.iinfo(np.int64).max
    before = np.concatenate([[none], np.where(close, rank[:-1], none)])
    after = np.concatenate([np.where(close, rank[1:], none), [none]])
    place = np.arange(len(rank))
    run_start = np.maximum.accumulate(np.where(rank == before, 0, place))
    good = ((place - run_start) % 2 == 0) & (rank <= before) & (rank <= after)
    # the start of a run of a better pair may touch the end of a run just chosen
    good[1:] &= ~(good[:-1] & close)
    return good


def frequent(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places whose key occurs `FREQUENT` times, the rank of each, the keys by rank): exact counts.

    Keys are counted by hash bin; only keys that share a bin with another one are sorted.
    """
    bits = min(BINS, max(6, len(key).bit_length()))
    bins = (key * 0x9E3779B97F4A7C1) >> (60 - bits) & ((1 << bits) - 1)
    at = np.flatnonzero(np.bincount(bins, minlength=1 << bits)[bins] >= FREQUENT)
    key, bins = key[at], bins[at]
    first = np.zeros(1 << bits, np.int64)
    first[bins] = key  # of a bin's keys one stands for it
    mixed = np.zeros(1 << bits, bool)
    mixed[bins[first[bins] != key]] = True
    # numbers of keys: bins of one key, then the keys of the others
    number = np.cumsum(np.bincount(bins, minlength=1 << bits) > 0) - 1
    which, keys = number[bins], np.zeros(int(number[-1]) + 1, np.int64)
    keys[which] = key
    shared = np.flatnonzero(mixed[bins])
    if len(shared):
        others, inverse = np.unique(key[shared], return_inverse=True)
        which[shared] = len(keys) + inverse
        keys = np.concatenate([keys, others])
    counts = np.bincount(which, minlength=len(keys))
    order = np.argsort(-counts, kind="stable")[: int((counts >= FREQUENT).sum())]
    rank = np.full(len(keys), -1, np.int64)
    rank[order] = np.arange(len(order))
    rank = rank[which]
    return at[rank >= 0], rank[rank >= 0], keys[order]


def compress(ids: np.ndarray, starts: np.ndarray, terminals: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, starts of the documents in them, rules) of the ids of a shard.

    Rounds go on until no pair within a document occurs `FREQUENT` times. All pairs are counted
    once. After that only pairs with a symbol that has just been put in can have become frequent,
    and of those that were, only occurrences that lost to a neighbour are left: a round looks at
    these places alone. What is replaced stays in place; each symbol knows its neighbours.
    """
    symbols, rules, size = ids.astype(np.uint32), [np.empty((0, 2), np.int64)], len(ids)
    after, before = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
    last, alive = np.zeros(size, bool), np.ones(size, bool)
    last[starts[1:] - 1] = True
    at, made = np.flatnonzero(~last), 0
    while len(at):
        right = after[at]
        often, rank, pairs = frequent((symbols[at].astype(np.int64) << 24) | symbols[right])
        if not len(often):
            break
        at, right = at[often], right[often]
        won = winners(right[:-1] == at[1:], rank)
        lost, at, right, rank = at[~won], at[won], right[won], rank[won]
        used = np.bincount(rank, minlength=len(pairs)) > 0
        symbols[at] = (terminals + made + np.cumsum(used) - 1)[rank]
        rules.append(np.stack([pairs[used] >> 24, pairs[used] & 0xFFFFFF], axis=1))
        made += len(rules[-1])
        alive[right], last[at] = False, last[right]
        following = after[right]
        after[at] = following
        inner = following < size
        before[following[inner]] = at[inner]
        again = np.zeros(size, bool)
        again[at] = again[np.maximum(before[at], 0)] = again[lost[alive[lost]]] = True
        at = np.flatnonzero(again & alive & ~last)
    place = np.cumsum(alive) - 1
    return symbols[alive], np.append(place, alive.sum())[starts], np.concatenate(rules)


def lengths_of(rules: np.ndarray, terminals: int) -> np.ndarray:
    """How many tokens each rule expands to; a rule refers to earlier ones only."""
    out, k = np.ones(terminals + len(rules), np.int64), 0
    while k < len(rules):  # together, the rules that refer to none of each other
        known = (rules[k:] < terminals + k).all(axis=1)
        stop = len(rules) if known.all() else k + int(np.argmin(known))
        out[terminals + k : terminals + stop] = out[rules[k:stop]].sum(axis=1)
        k = stop
    return out[terminals:]


def write_shard(out, docs: list[int | None], tokens: list[np.ndarray], terminals: int) -> None:
    """One shard file to an open stream."""
    ids = np.concatenate(tokens)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    symbols, starts, rules = compress(ids, starts, terminals)
    out.write(MAGIC)
    out.write(np.array([len(docs), len(rules), len(symbols), terminals], "<i8").tobytes())
    out.write(np.array([0 if d is None else d for d in docs], "<i8").tobytes())
    out.write(np.array([d is None for d in docs], np.uint8).tobytes())
    out.write(starts.astype("<i8").tobytes())
    out.write(rules.T.astype("<u4").tobytes())
    out.write(lengths_of(rules, terminals).astype("<i8").tobytes())
    out.write(symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes())


class Shard:
    """A shard file: whole documents, or any range of tokens of one."""

    def __init__(self, data: bytes):
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a grammar shard")
        at = len(MAGIC)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, kind, n, at)
            at += out.nbytes
            return out

        docs, rules, symbols, self.terminals = take("<i8", 4).tolist()
        ids, null = take("<i8", docs), take("u1", docs)
        self.docs = [None if n else i for i, n in zip(ids.tolist(), null.tolist())]
        self.starts = take("<i8", docs + 1)
        self.rules = take("<u4", 2 * rules).reshape(2, rules).T.astype(np.int64)
        self.lengths = np.concatenate([np.ones(self.terminals, np.int64), take("<i8", rules)])
        packed = np.zeros((symbols, 4), np.uint8)
        packed[:, :3] = take("u1", 3 * symbols).reshape(symbols, 3)
        self.symbols = packed.view("<u4").ravel()
        # what every symbol expands to, one after the other
        self.places = np.concatenate([[0], np.cumsum(self.lengths)])
        self.tokens = np.empty(self.places[-1], "<u4")
        self.tokens[: self.terminals] = np.arange(self.terminals)
        for k, (a, b) in enumerate(self.rules.tolist()):
            start, middle = self.places[self.terminals + k], self.places[self.terminals + k] + self.lengths[a]
            self.tokens[start:middle] = self.tokens[self.places[a] : self.places[a + 1]]
            self.tokens[middle : self.places[self.terminals + k + 1]] = self.tokens[self.places[b] : self.places[b + 1]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        """The token ids of symbols."""
        lengths = self.lengths[symbols]
        shift = self.places[symbols] - (np.cumsum(lengths) - lengths)
        return self.tokens[np.repeat(shift, lengths) + np.arange(lengths.sum())]

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.starts[k] : self.starts[k + 1]])

    def token_range(self, k: int, first: int, stop: int) -> np.ndarray:
        """Tokens first..stop of document k; only the symbols that reach into them are expanded."""
        symbols = self.symbols[self.starts[k] : self.starts[k + 1]]
        ends = np.cumsum(self.lengths[symbols])
        a, b = np.searchsorted(ends, first, "right"), np.searchsorted(ends, stop, "left") + 1
        before = int(ends[a - 1]) if a else 0
        return self.expand(symbols[a:b])[first - before : stop - before]


def slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in tables of about `SLICE` bytes of text, across batches; one row at least."""
    pending, held = [], 0
    for batch in batches:
        for a, b in text_slices(batch.column(1), SLICE // 4):
            pending.append(batch.slice(a, b - a))
            held += pc.sum(pc.binary_length(pending[-1].column(1))).as_py() or 0
            if held >= SLICE:
                yield pa.Table.from_batches(pending)
                pending, held = [], 0
    if pending:
        yield pa.Table.from_batches(pending)


MANIFEST = "part int, seq int, path string, docs long, tokens long"


def _write(batches: Iterable[pa.RecordBatch], path: str, folder: str) -> Iterator[pa.RecordBatch]:
    """Shard files of a partition's sorted documents; yields one manifest row a file.

    Every attempt writes files of its own; those of a lost one are in no manifest.
    """
    encoder = kept_by_worker(("encoder", path), lambda: LibraryEncoder(path))
    part = TaskContext.get().partitionId()
    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    docs: list[int | None] = []
    tokens: list[np.ndarray] = []
    held, seq = 0, 0
    end = np.array([END], "<u4")

    def close() -> pa.RecordBatch:
        name = f"{part:06d}-{seq:06d}-{uuid.uuid4().hex}.repair"
        with system.open_output_stream(f"{root}/{name}") as out:
            write_shard(out, docs, tokens, len(encoder.lengths))
        row = [[part], [seq], [f"{folder}/{name}"], [len(docs)], [held]]
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, t) for v, t in zip(row, kinds)], ["part", "seq", "path", "docs", "tokens"]
        )

    for rows in slices(batches):
        for doc, ids in zip(rows.column(0).to_pylist(), encoder.encode(rows.column(1).to_pylist())):
            docs.append(doc)
            tokens.append(np.concatenate([ids, end]))
            held += len(ids) + 1
            if held >= SHARD:
                yield close()
                docs, tokens, held, seq = [], [], 0, seq + 1
    if docs:
        yield close()


def write(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """Write the ids of all documents, in ascending doc_id order, as shards in `folder`.

    Returns the manifest: path, docs, tokens and `start`, the ids in all shards before. A null text
    is an empty one, which holds just the end id; rows without doc_id come first, and rows that
    repeat an id are ordered by text. An empty table has an empty manifest.
    """
    folder = folder or new_path(docs.sparkSession, "shards")
    # rows of one id, or of none, are cut where their texts differ early on
    rows = docs.select("doc_id", "text", F.substring("text", 1, 64).alias("start"))
    ordered = rows.repartitionByRange("doc_id", "start").sortWithinPartitions("doc_id", "text")
    manifest = staged(ordered.mapInArrow(partial(_write, path=path, folder=folder), MANIFEST), "manifest")
    # one row a task: the window holds as many rows as there were partitions
    parts = manifest.groupBy("part").agg(F.sum("tokens").alias("in_part"))
    before = F.sum("in_part").over(Window.orderBy("part")) - F.col("in_part")
    starts = parts.select("part", before.alias("before"))
    earlier = F.sum("tokens").over(Window.partitionBy("part").orderBy("seq")) - F.col("tokens")
    return manifest.withColumn("start", earlier).join(starts, "part").select(
        "path", "docs", "tokens", (F.col("start") + F.col("before")).alias("start")
    )


CHECKS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def load(path: str) -> Shard:
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_stream(name) as file:
        return Shard(file.read())


def _read(batches: Iterable[pa.RecordBatch], ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            shard = load(path)
            tokens = [shard.document(k) for k in range(len(shard.docs))]
            sizes = np.array([len(t) for t in tokens], np.int64)
            columns = {"doc_id": pa.array(shard.docs, pa.int64())}
            columns["start"] = pa.array(start + np.cumsum(sizes) - sizes)
            columns["n_tokens"] = pa.array(sizes)
            if ids:
                columns["ids"] = pa.array([t.tobytes() for t in tokens], pa.binary())
            else:
                columns["ids_crc32"] = pa.array([zlib.crc32(t) for t in tokens], pa.int64())
            yield pa.RecordBatch.from_pydict(columns)


def read(manifest: DataFrame, ids: bool = False) -> DataFrame:
    """The documents of the shards: doc_id, start, n_tokens and ids_crc32, or the `ids` themselves."""
    fields = CHECKS.replace("ids_crc32 long", "ids binary") if ids else CHECKS
    # files are dealt to all cores; their names say nothing of their sizes
    tasks = 4 * manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.select("path", "start").repartition(tasks, "path").mapInArrow(partial(_read, ids=ids), fields)


def write_and_read(docs: DataFrame, path: str) -> DataFrame:
    """Per document, from the files written: doc_id, start, n_tokens, ids_crc32."""
    return read(write(docs, path))
