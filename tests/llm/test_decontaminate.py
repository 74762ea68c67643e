import random

import numpy as np
import pytest

from cohortforge.llm import decontaminate as d

ITEMS = "item_id long, text string"


def brute_align(item, region):
    """The plain table of Smith-Waterman scores."""
    table = np.zeros((len(item) + 1, len(region) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(region) + 1):
            step = d.MATCH if item[i - 1] == region[j - 1] else d.MISMATCH
            table[i, j] = max(0, table[i - 1, j - 1] + step, table[i - 1, j] + d.GAP, table[i, j - 1] + d.GAP)
    return table.max()


def test_alignment_against_the_plain_table():
    rng = random.Random(1)
    for _ in range(300):
        item = np.array([rng.randint(0, 4) for _ in range(rng.randint(1, 12))], np.uint64)
        region = np.array([rng.randint(0, 4) for _ in range(rng.randint(0, 20))], np.uint64)
        score, start, end = d.align(item, region)
        assert score == brute_align(item, region)
        assert brute_align(item, region[start:end]) == score


def corpus(spark, frame):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(300)]
    make = lambda n: [rng.choice(words) for _ in range(n)]
    items = [make(rng.randint(15, 60)) for _ in range(30)]
    template = make(12)
    items += [template + make(30) for _ in range(10)]  # items that begin alike
    rows, truth = [], set()
    for doc in range(300):
        text = make(rng.randint(5, 200))
        if doc % 3 == 0:
            k = rng.randrange(len(items))
            copy = list(items[k])
            for _ in range(len(copy) // 6 if doc % 2 else 0):  # edited: replaced, dropped or added
                at = rng.randrange(len(copy))
                copy[at : at + 1] = rng.choice([[rng.choice(words)], [], [copy[at], rng.choice(words)]])
            at = rng.randint(0, len(text))
            text[at:at] = copy
            truth.add((doc, k))
        if doc % 10 == 1:
            text += template
        mark = rng.choice(["", ",", "!!"])  # other punctuation and case are no difference
        rows.append((doc, f"{mark} ".join(text).title()))
    return frame(rows), spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(items)], ITEMS), truth


def test_copies_and_edited_copies_are_found(spark, frame):
    docs, items, truth = corpus(spark, frame)
    found = {(r["doc_id"], r["item_id"]): r for r in d.contaminated(docs, items).collect()}
    assert found.keys() == truth
    texts = {r["doc_id"]: r["text"].lower().replace(",", "").replace("!!", "").split() for r in docs.collect()}
    wanted = {r["item_id"]: r["text"].split() for r in items.collect()}
    for (doc, item), r in found.items():
        part = texts[doc][r["start_word"] : r["end_word"]]
        assert r["score"] == pytest.approx(brute_align(wanted[item], texts[doc]) / (2 * len(wanted[item])))
        assert brute_align(wanted[item], part) / (2 * len(wanted[item])) == pytest.approx(r["score"])


def test_runs_of_three_words_between_edits_are_found(spark, frame):
    """The n-grams the edits break occur nowhere in documents, or (item 2) in a whole copy elsewhere."""
    items = [[f"{name}{k}" for k in range(16)] for name in "ab"]
    edited = [[f"x{k}" if k % 4 == 3 else word for k, word in enumerate(item)] for item in items]
    docs = frame([(k, " ".join(words)) for k, words in enumerate([*edited, items[1]], 1)])
    wanted = spark.createDataFrame([(k, " ".join(item)) for k, item in enumerate(items, 1)], ITEMS)
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in d.contaminated(docs, wanted).collect()}
    assert found.keys() == {(1, 1), (2, 2), (3, 2)}
    for k in (0, 1):
        assert found[k + 1, k + 1] == pytest.approx(brute_align(items[k], edited[k]) / 32) and found[k + 1, k + 1] >= 0.6


def test_all_edits_within_the_least_score_are_found(spark, frame):
    """Every third word replaced or dropped, a word after each, in a text whose pairs occur elsewhere too."""
    item = [f"w{k}" for k in range(30)]
    edits = {
        1: ["x" if k % 3 == 2 else w for k, w in enumerate(item)],
        2: [w for k, w in enumerate(item) if k % 3 != 2],
        3: [x for w in item for x in (w, "y")],
        4: item[:13],
    }
    rows = [(k, " ".join(["z"] * 9 + words + ["z"] * 9)) for k, words in edits.items()]
    rows += [(100 + k, " ".join([item[k], item[k + 1], "z", item[k], "z", item[k + 2]])) for k in range(28) for _ in range(1 + k % 5)]
    found = {r["doc_id"]: r["score"] for r in d.contaminated(frame(rows), spark.createDataFrame([(1, " ".join(item))], ITEMS)).collect()}
    expected = {k: brute_align(item, words) / 60 for k, words in edits.items()}
    assert min(expected.values()) >= d.ALIGNED and found == pytest.approx(expected)


def test_texts_of_one_item_and_short_items(spark, frame):
    docs = frame([(1, "so the quick brown fox jumps"), (2, "a lazy dog sleeps all day long"), (3, "one hello World"), (4, "hello there world"), (5, "yes")])
    items = [(1, "the quick brown fox jumps"), (1, "lazy dog sleeps all day long"), (2, "Hello, world!"), (3, "yes"), (4, "!!")]
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in d.contaminated(docs, spark.createDataFrame(items, ITEMS)).collect()}
    assert found == {(1, 1): 1.0, (2, 1): 1.0, (3, 2): 1.0, (5, 3): 1.0}


def test_against_every_alignment_of_the_table(spark, sf_dir):
    """Brute force: each document aligned with each item, without seeds or regions."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    texts, wanted = ([tuple(r) for r in df.collect()] for df in (docs.select("doc_id", "text"), items.select("item_id", "text")))
    hashes, starts = d.word_hashes([t for _, t in texts], marks=False)
    item_hashes, item_starts = d.word_hashes([t for _, t in wanted], marks=False)
    expected = {}
    for k, (doc, _) in enumerate(texts):
        words = hashes[starts[k] : starts[k + 1]]
        for j, (name, _) in enumerate(wanted):
            item = item_hashes[item_starts[j] : item_starts[j + 1]]
            if d.reachable(item, words) >= d.ALIGNED * d.MATCH * len(item):
                score = d.align(item, words)[0] / (d.MATCH * len(item))
                if score >= d.ALIGNED:
                    expected[doc, name] = max(score, expected.get((doc, name), 0))
    found = {(r["doc_id"], r["item_id"]): r["score"] for r in d.contaminated(docs, items).collect()}
    assert expected and found == expected


def test_rare_seeds_are_chosen(spark):
    """Of ten words, with 0.4 of the score, the three commonest beginnings are left out."""
    rows = [(1, at * 10, at, 10) for at in range(9)]
    seeds = spark.createDataFrame(rows, "key long, gram long, at int, words int")
    counts = spark.createDataFrame([(at * 10, 100 - at) for at in range(8)], "gram long, n long")
    assert sorted(r["at"] for r in d.chosen_seeds(seeds, counts, 0.4).collect()) == [2, 3, 4, 5, 6, 7, 8]


def test_bound_of_the_alignment():
    rng = random.Random(2)
    for _ in range(300):
        item = np.array([rng.randint(0, 9) for _ in range(rng.randint(1, 12))], np.uint64)
        region = np.array([rng.randint(0, 9) for _ in range(rng.randint(0, 9))], np.uint64)
        assert brute_align(item, region) <= d.reachable(item, region) <= d.MATCH * len(item)


def test_whole_table_against_search(spark, sf_dir):
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    plain = lambda t: " " + " ".join(t.lower().split()) + " "
    texts = {r["doc_id"]: plain(r["text"]) for r in docs.collect()}
    copied = {(i, r["item_id"]) for r in items.collect() for i, t in texts.items() if plain(r["text"]) in t}
    found = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()}
    assert copied and copied <= found


def test_edges(spark, edges, nothing):
    none = spark.createDataFrame([], ITEMS)
    odd = spark.createDataFrame([(None, "one two three four five"), (1, None), (2, ""), (3, "a b"), (4, ".,")], ITEMS)
    assert d.contaminated(edges, none).collect() == []
    assert d.contaminated(edges, odd).collect() == []
    item = spark.createDataFrame([(9, "ONE two three four five"), (9, "ONE two three four five")], ITEMS)
    found = d.contaminated(edges, item).collect()
    assert sorted((r["doc_id"], r["item_id"], r["score"]) for r in found) == [(-8, 9, 1.0), (4, 9, 1.0)]
    kept = d.drop_contaminated(edges, item)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 2, 3, 5, 6, 7]
    assert d.contaminated(nothing, item).collect() == []
