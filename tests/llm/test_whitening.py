import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortforge.llm import whitening
from cohortforge.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, components=4):
    """(vec_id, component) -> (n, deviation, |whitened|, explained), for distinct ids."""
    kept = {}
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            kept[i] = tuple(math.floor(256 * float(np.float32(c))) for c in v)
    size = max(map(len, kept.values()))
    kept = {i: x + (0,) * (size - len(x)) for i, x in kept.items()}
    fit = sorted(set(kept.values()))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = np.array([s / n for s in sums])
    off = np.array(fit, float) - mean
    values, vectors = np.linalg.eigh(off.T @ off / n)
    order = np.argsort(-values)[:components]
    out = {}
    for i, x in kept.items():
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for k, j in enumerate(order):
            white = abs((np.array(x, float) - mean) @ vectors[:, j]) / math.sqrt(values[j]) if values[j] > 1e-9 else None
            out[i, k + 1] = (n, deviation, white, values[j] / values.sum() if values.sum() > 0 else None)
    return out


def same(df, expected, error=1e-9):
    rows = df.collect()
    assert len(rows) == len(expected) == len({(r["vec_id"], r["component"]) for r in rows})
    for r in rows:
        n, deviation, white, share = expected[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert (r["whitened"] is None) == (white is None) and (r["explained"] is None) == (share is None)
        assert white is None or abs(abs(r["whitened"]) - white) < 1e-6
        assert share is None or abs(r["explained"] - share) < 1e-9
    assert len({r["identity_error"] for r in rows}) == 1
    assert rows[0]["identity_error"] is None or rows[0]["identity_error"] < error
    return rows


def vectors(n=500, size=9, seed=5):
    rng = np.random.default_rng(seed)
    scale = rng.permutation(np.arange(1, size + 1)) * 0.4
    return (rng.normal(size=(n, size)) * scale + 1).tolist()


def test_against_numpy_with_copies(spark):
    rows = list(enumerate(vectors()))
    rows += [(1000 + k, rows[3][1]) for k in range(300)]  # a third of the rows are one vector
    same(whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5)), brute(rows))


def test_many_blocks_in_both_directions(spark, monkeypatch):
    for name, value in (("LEAST_ROWS", 7), ("WISHED_BLOCKS", 1000), ("MOST_COLUMNS", 4), ("TASK_BLOCKS", 3)):
        monkeypatch.setattr(whitening, name, value)
    rows = list(enumerate(vectors(200)))
    same(whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(3)), brute(rows))


def test_rows_of_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding").collect()]
    df = QUERIES["op11_whitening"](spark, sf_dir)
    assert dict(df.dtypes)["deviation"] == dict(df.dtypes)["n"] == "bigint"
    same(df, brute(rows))


def test_edges_and_extra_columns(spark):
    nan, inf = float("nan"), float("inf")
    rows = list(enumerate(vectors(40, 5))) + [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [nan] * 5), (103, [inf] + [0.0] * 4), (104, [-inf] * 5)]
    rows += [(105, []), (106, [1.0, 2.0]), (107, [-0.0] * 5), (108, [0.0] * 5)]
    frame = spark.createDataFrame(rows, VECTORS)
    for name in ("row", "x", "v", "index", "white", "deviation", "n", "_part", "component"):
        frame = frame.withColumn(name, F.lit("mine"))
    same(whitening.whiten(frame), brute(rows))
    assert whitening.whiten(frame.limit(0)).collect() == []
    assert whitening.whiten(frame.where("vec_id between 100 and 105")).collect() == []
    twice = whitening.whiten(frame.unionByName(frame).withColumn("vec_id", F.lit(None).cast("long")))
    assert twice.count() == 2 * 4 * 44


@pytest.mark.parametrize("rows", [[(1, [0.5, 1.5])], [(1, [0.5, 1.5]), (2, [0.5, 1.5])]])
def test_one_vector_has_no_variance(spark, rows):
    out = same(whitening.whiten(spark.createDataFrame(rows, VECTORS)), brute(rows))
    assert {r["whitened"] for r in out} == {None}


def test_flat_components(spark):
    rows = [(k, [float(k), 2.0 * k, -1.0]) for k in range(9)]
    out = same(whitening.whiten(spark.createDataFrame(rows, VECTORS)), brute(rows))
    assert {r["component"] for r in out if r["whitened"] is None} == {2, 3}


def test_large_entries(spark):
    rows = [(k, [3e12 * (k % 3), -5e11 * k]) for k in range(9)]
    same(whitening.whiten(spark.createDataFrame(rows, VECTORS)), brute(rows))
    assert whitening.whiten(spark.createDataFrame([*rows, (10, [3e38, -3e38])], VECTORS)).count() == 20
