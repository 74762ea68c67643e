"""Chains of upserts and comparisons of releases, whose tables are shuffled once."""

import random

import pytest
from pyspark.sql import functions as F

from cohortforge import operators as O

KEYS = ["a", "b"]


@pytest.fixture
def shuffled(spark):
    """Joins as of long tables: none is broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange " in line]


def keys_of(rng, n):
    return [(rng.choice([None, *range(9)]), rng.choice([None, *"pqrs"])) for _ in range(n)]


def upserted(target, source, mark):
    """A mark on the target's rows whose key the source has, and rows for its other keys."""
    known, named = {r[:2] for r in target}, set(source)
    matched = {k for k in known & named if None not in k}
    return [(*r[:2], mark if r[:2] in matched else r[2], r[3]) for r in target] + [(*k, mark, None) for k in named - matched]


def test_a_chain_of_upserts_shuffles_its_target_once(spark, shuffled, tmp_path):
    rng = random.Random(3)
    expected = [(*k, "old", n) for n, k in enumerate(keys_of(rng, 40))]
    spark.createDataFrame(expected, "a int, b string, mark string, n int").write.parquet(f"{tmp_path}/target")
    rows = spark.read.parquet(f"{tmp_path}/target").repartition(*KEYS)
    for step in range(3):
        source = keys_of(rng, 20)
        spark.createDataFrame(source, "a int, b string").write.parquet(f"{tmp_path}/{step}")
        mark = {"mark": F.lit(f"m{step}")}
        rows = O.upsert(rows, spark.read.parquet(f"{tmp_path}/{step}").repartition(*KEYS), KEYS, mark, mark)
        expected = upserted(expected, source, f"m{step}")
    assert len(exchanges(rows)) == 4  # the target and three sources
    assert sorted(map(str, map(tuple, rows.collect()))) == sorted(map(str, expected))


def test_only_new_keys_are_inserted_where_rows_lie(spark, shuffled, tmp_path):
    rng = random.Random(4)
    held, fresh = ([(*k, rng.randrange(3), "x") for k in keys_of(rng, 60)] for _ in range(2))
    layout = "a int, b string, n int, v string"
    for name, rows in (("held", held), ("fresh", fresh + fresh[:20])):
        spark.createDataFrame(rows, layout).write.parquet(f"{tmp_path}/{name}")
    target = spark.read.parquet(f"{tmp_path}/held").repartition(*KEYS)
    source = spark.read.parquet(f"{tmp_path}/fresh").select("a", "b", "n").repartition(*KEYS)
    got = O.upsert(target, source, KEYS, on_insert={"v": F.concat(F.lit("new "), F.col("n").cast("string"))})
    assert len(exchanges(got)) == 2  # the target and the source
    known = {r[:2] for r in held if None not in r[:2]}
    expected = held + [(*r, f"new {r[2]}") for r in {r[:3] for r in fresh} if r[:2] not in known]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_values_of_a_source_update_and_insert(spark):
    target = spark.createDataFrame([(1, "p", "old"), (1, "p", "twice"), (2, None, "n")], "a int, b string, v string")
    source = spark.createDataFrame([("new", 1, "p"), ("new", 1, "p"), ("none", 2, None), (None, 3, "q")], "v string, a int, b string")
    got = O.upsert(target, source, KEYS, {"v": F.concat(F.col("v"), F.lit(" "), F.col("_new_v"))})
    expected = [(1, "p", "old new"), (1, "p", "twice new"), (2, None, "n"), (2, None, "none"), (3, "q", None)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))
    unequal = source.union(spark.createDataFrame([("other", 1, "p")], "v string, a int, b string"))
    with pytest.raises(Exception, match="source rows differ for one key"):
        O.upsert(target, unequal, KEYS, {"v": F.col("_new_v")}).collect()


def test_releases_meet_in_one_shuffle(spark, shuffled, tmp_path):
    rng = random.Random(5)
    layout, sides = "a int, b string, v string, w long", []
    for name in ("before", "after"):
        rows = {k: (rng.choice([None, "x", "y"]), rng.choice([None, 1, 2])) for k in keys_of(rng, 40)}
        spark.createDataFrame([(*k, *v) for k, v in rows.items()], layout).write.parquet(f"{tmp_path}/{name}")
        sides.append(rows)
    changes = O.table_changes(*(spark.read.parquet(f"{tmp_path}/{name}") for name in ("before", "after")), KEYS)
    assert len(exchanges(changes)) == 1
    before, after = sides
    expected = {}
    for k in before.keys() | after.keys():
        if k not in before or k not in after:
            expected[k] = ("inserted" if k in after else "deleted", None)
        elif before[k] != after[k]:
            expected[k] = ("updated", [c for c, x, y in zip("vw", before[k], after[k]) if x != y])
    found = changes.collect()
    assert {(r["a"], r["b"]): (r["change"], r["columns"]) for r in found} == expected and len(found) == len(expected)
