import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortforge.llm import near_dedup
from cohortforge.llm.components import components
from cohortforge.llm.words import shingle_sets, word_hashes

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) >= 5:
        return frozenset(zip(*[words[k:] for k in range(5)]))
    return frozenset([tuple(words)]) if words else frozenset()


def brute(rows):
    """doc_id -> (set sizes, component) by comparing every pair that shares a shingle."""
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    holders = defaultdict(list)
    for k, (_, s) in enumerate(sets):
        for g in s:
            holders[g].append(k)
    for k, (i, s) in enumerate(sets):
        for j, n in Counter(j for g in s for j in holders[g] if j < k).items():
            if 100 * n >= 75 * (len(s) + len(sets[j][1]) - n):
                a, b = find(i), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in parent}


def check(docs):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found, expected = near_dedup.near_duplicates(docs).collect(), brute(rows)
    assert len(found) == len(rows)
    for r in found:
        assert r["component_id"] == (None if r["doc_id"] is None else expected[r["doc_id"]])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    assert sorted(r["n_shingles"] for r in found) == sorted(len(shingles(t)) for _, t in rows)
    return found


def corpus(seed, size):
    """Random texts, exact and edited copies, chains of edits, and a passage that many share."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows, texts = [], []
    for i in range(size):
        kind = rng.random()
        if texts and kind < 0.55:
            words = list(rng.choice(texts if kind < 0.3 else texts[:3]))
            for _ in range(rng.randint(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
        else:
            words = [rng.choice(vocabulary) for _ in range(rng.randint(3, 90))]
            if kind > 0.85:
                words += passage
        texts.append(words)
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("node", [512, 6])
def test_against_brute_force(frame, monkeypatch, node):
    """Small nodes take the path through all branchings and the pairs of blocks."""
    monkeypatch.setattr(near_dedup, "NODE", node)
    check(frame(corpus(node, 400)))


def test_confirming_groups_in_blocks(frame, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 500)
    check(frame(corpus(3, 300)))


def test_edge_rows(edges, nothing):
    found = check(edges)
    assert {(r["doc_id"], r["component_id"]) for r in found} >= {(1, 1), (2, 2), (3, 3), (4, -8), (-8, -8)}
    assert near_dedup.near_duplicates(nothing).collect() == []


def test_keep_one(edges, nothing):
    kept = near_dedup.keep_one(edges)
    assert kept.columns == edges.columns
    ids = sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in kept.collect())
    assert ids == [(False, 0), (True, -8), (True, 1), (True, 2), (True, 3), (True, 5), (True, 6), (True, 7)]
    assert near_dedup.keep_one(nothing).collect() == []


def test_word_hashes_do_not_depend_on_neighbours():
    texts = ["a b", "A\tB", "", None, "b", "x\nb\x0b", "é b"]
    hashes, starts = word_hashes(texts)
    assert np.diff(starts).tolist() == [2, 2, 0, 0, 1, 2, 2]
    assert hashes[0] == hashes[2] and hashes[1] == hashes[3] == hashes[4] == hashes[6] == hashes[8]
    assert len(set(hashes.tolist())) == 4
    assert [len(s) for s in shingle_sets(["", "a", "a b c d", "a b c d e", "a b c d e f", "a a a a a a a"])] == [0, 1, 1, 1, 2, 1]


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    pairs = [(k, k + 1) for k in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(300, 300)]
    pairs += [(rng.randint(400, 480), rng.randint(400, 480)) for _ in range(60)]
    parent = {x: x for p in pairs for x in p}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    rng.shuffle(pairs)
    found = components(spark.createDataFrame(pairs, "u long, v long")).collect()
    assert sorted(map(tuple, found)) == sorted((x, find(x)) for x in parent if find(x) != x)
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
