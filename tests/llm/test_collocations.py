import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortforge.llm import collocations
from conftest import EDGES

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least=10, share=50, top=2000, longest=3):
    counts = defaultdict(Counter)
    for _, text, lang in rows:
        text = (text or "").translate(str.maketrans(collocations.UPPER, collocations.LOWER))
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", text):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            for size in range(1, longest + 1):
                counts[lang or "und" if lang is None else lang].update(
                    tuple(words[i : i + size]) for i in range(len(words) - size + 1)
                )
    out = []
    for lang, f in counts.items():
        n = sum(c for g, c in f.items() if len(g) == 1)
        found = []
        for g, a in f.items():
            if len(g) < 2 or a < least:
                continue
            longer = (h for h in f if len(h) > len(g) and f[h] >= least and 100 * f[h] >= share * a)
            if any(h[i : i + len(g)] == g for h in longer for i in range(len(h) - len(g) + 1)):
                continue
            score, k = min((1000000 * a * a // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):  # noqa: E741
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def corpus(seed, n=60):
    """Few words, so that phrases are frequent, with stops, copies and other letters between."""
    random.seed(seed)
    words = ["The", "the", "cat", "sat", "on", "mat", "É", "ß x", "a-b", "zz"]
    rows = []
    for k in range(n):
        text = "".join(
            random.choice(words) + random.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " \x0b"])
            for _ in range(random.randint(0, 60))
        )
        rows.append((k, text, random.choice(["en", "en", "de", None, "und"])))
    return rows + [(n + k, rows[0][1], "en") for k in range(40)]


def found(frame, **options):
    return sorted(map(tuple, collocations.collocations(frame, **options).collect()))


@pytest.mark.parametrize("options", [{}, {"least": 2, "top": 5}, {"least": 3, "share": 90, "longest": 4}])
def test_against_brute_force(spark, options):
    rows = corpus(len(options))
    docs = spark.createDataFrame(rows, SCHEMA)
    expected = brute(rows, **options)
    assert expected and found(docs, **options) == expected


def test_many_frequent_groups_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SMALL", 0)
    rows = corpus(7)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_words_with_one_id_are_told_apart(spark, monkeypatch):
    real = collocations.word_id

    def poor(lang, text, seed):
        return F.pmod(real(lang, text, seed), F.lit(3)) if seed == 0 else real(lang, text, seed)

    monkeypatch.setattr(collocations, "word_id", poor)
    rows = corpus(3)
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_edges_and_extra_columns(spark, edges):
    for name in ("piece", "pos", "deal", "copies", "w1", "f", "a", "word"):
        edges = edges.withColumn(name, F.lit("mine"))
    rows = [(i, t, None) for i, t in EDGES]
    assert found(edges) == brute(rows)
    assert found(edges.limit(0)) == []


def test_joins_take_relations_as_they_lie(spark):
    relations = collocations.Relations(spark)
    rows = spark.range(200).selectExpr("cast(id % 16 as int) as deal", "id div 10 as piece", "cast(id % 10 as int) as pos", "id % 7 as w1", "1L as copies")
    with collocations.co_partitioned(spark):
        single = relations.write(rows)
        grown = collocations.extend(single, 1)
        plan = grown._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        expected = sum(r["id"] % 10 < 9 and r["id"] + 1 < 200 and (r["id"] + 1) % 16 == r["id"] % 16 for r in spark.range(200).collect())
        assert grown.count() == expected
    relations.drop()
