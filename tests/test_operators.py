import hashlib
import random
import statistics

import pytest
from pyspark.sql import functions as F

from cohortforge import operators as O
from cohortforge.operators.profile import counted_median
from cohortforge.plans.diagnoses import FIVE_KEYS, FLAGS, diagnosis_counts
from cohortforge.study import Study
from testbed.sources import CONFIG, study


def pairs(df):
    return {tuple(r) for r in df.collect()}


def test_dense_key_is_dense_and_stable(spark):
    first = spark.createDataFrame([(f"p{i}",) for i in range(500)] * 2, "k string")
    ids = {r.k: r.id for r in O.dense_key(first, "k", "id", "salt").collect()}
    order = sorted(ids, key=lambda k: hashlib.sha256(f"salt{k}".encode()).hexdigest())
    assert [ids[k] for k in order] == list(range(1, 501))

    more = spark.createDataFrame([(f"p{i}",) for i in range(450, 700)], "k string")
    kept = spark.createDataFrame(list(ids.items()), "k string, id long")
    grown = {r.k: r.id for r in O.dense_key(more, "k", "id", "salt", existing=kept).collect()}
    assert all(grown[k] == ids[k] for k in ids)
    assert sorted(grown.values()) == list(range(1, 701))


def test_dense_key_keeps_no_single_task_window(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    plan = O.dense_key(df, "k", "n")._jdf.queryExecution().optimizedPlan().toString()
    numbered = [line for line in plan.splitlines() if "row_number" in line and "Window" in line]
    assert numbered and all("_bucket" in line for line in numbered)


def test_panel_stats_against_brute_force(spark):
    rng = random.Random(5)
    rows = [("hot", rng.choice([1.5, 2.0, 7.25, 90.0])) for _ in range(4000)]
    rows += [("hot", rng.random() * 1e6) for _ in range(2001)]
    rows += [("even", float(v)) for v in (1, 2, 3, 10)] + [("one", 4.0), ("none", None)]
    rows += [("tied", 3.0), ("tied", 3.0), ("tied", 2.0), ("tied", 2.0), ("tied", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in O.panel_stats(df, "g", "v").collect()}
    for group in ("hot", "even", "one", "tied"):
        values = [v for g, v in rows if g == group and v is not None]
        assert got[group].median_value == statistics.median(values)
        assert got[group].avg_value == pytest.approx(statistics.fmean(values))
        assert got[group].mode_value == min(statistics.multimode(values))
    assert got["none"].median_value is None and got["none"].mode_value is None


def test_latest_records_keeps_ties_and_drops_undated(spark):
    rows = [("a", 1, 1), ("a", 3, 2), ("a", 3, 3), ("a", None, 4), ("b", None, 5), ("c", 0, 6)]
    df = spark.createDataFrame(rows, "k string, t int, n int")
    assert {r.n for r in O.latest_records(df, "k", "t").collect()} == {2, 3, 6}


def test_label_cohort_partitions_keys(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, a int")
    b = spark.createDataFrame([("y", None), ("z", 4)], "k string, b int")
    got = O.label_cohort(a, b, "k", ("both", "a", "b")).select("k", "cohort_type")
    assert pairs(got) == {("x", "a"), ("y", "both"), ("z", "b")}


def test_count_steps_against_plain_counts(spark):
    rows = [("a", 1, 2), ("a", 0, 1), ("b", 0, 1), (None, 1, 1), ("c", 0, 0)]
    df = spark.createDataFrame(rows, "pat_id string, x int, y int")
    got = O.count_steps(df, {"one": ("x", "first"), "two": ("y", "second")})
    assert pairs(got) == {("one", 1, 2, "first"), ("two", 2, 5, "second")}
    empty = O.count_steps(df.limit(0), {"one": ("x", "first")})
    assert pairs(empty) == {("one", 0, 0, "first")}


def test_median_of_a_heavy_tail_ranks_a_small_slice(spark):
    """One far outlier leaves the others in many slices, and only one of them is ranked."""
    rng = random.Random(9)
    values = [rng.random() for _ in range(20_000)] + [1e300, -1e300, 5.0]
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    counted = df.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = counted_median(counted, "g", "v", "n").first()
    assert got.median_value == statistics.median(values)
    cuts = counted.agg(F.percentile_approx("v", [k / 64 for k in range(1, 64)], 1280)).first()[0]
    largest = max(sum(a <= v < b for v in values) for a, b in zip(cuts, cuts[1:]))
    assert largest < len(values) / 32


def test_upsert_is_idempotent_and_ignores_null_keys(spark):
    target = spark.createDataFrame([(1, "a", None), (None, "b", None)], "k int, s string, f string")
    source = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    flag = {"f": F.lit("Y")}
    once = O.upsert(target, source, ["k"], flag, {**flag, "s": F.lit("new")})
    assert pairs(once) == {(1, "a", "Y"), (None, "b", None), (2, "new", "Y")}
    twice = O.upsert(once, source, ["k"], flag, {**flag, "s": F.lit("new")})
    assert pairs(twice) == pairs(once)


def test_insert_only_upsert(spark):
    target = spark.createDataFrame([(1, 9, "P"), (1, 10, "P")], "k int, t int, f string")
    source = spark.createDataFrame([(1, 9), (2, 9), (2, 10)], "k int, t int")
    got = O.upsert(target, source, ["k"], on_insert={"f": F.lit("S")})
    assert pairs(got) == {(1, 9, "P"), (1, 10, "P"), (2, 9, "S"), (2, 10, "S")}


def test_profile_counts_missing_values(spark):
    df = spark.createDataFrame(
        [(1, "p", None), (1, "p", None), (1, "q", "x")], "g int, id string, a string"
    )
    got = O.profile(df, "g", {"A": "a"}, "id")
    assert pairs(got) == {(1, "A", None, 1), (1, "A", "x", 1)}


def test_check_private_refuses_raw_identifiers(spark):
    df = spark.createDataFrame([(1, 2)], "study_id int, PAT_ID int")
    with pytest.raises(ValueError, match="pat_id"):
        O.check_private(df)


def test_one_pass_diagnoses_equal_the_steps(spark, sf_dir):
    s = study(spark, sf_dir)
    columns = [*FIVE_KEYS, *FLAGS]
    one, steps = s("diagnosis_fact").select(columns), s("dx_flag_poa").select(columns)
    assert one.count() == steps.count() > 0
    assert one.exceptAll(steps).count() == 0


def test_study_without_store_stays_lazy(spark, sf_dir):
    stored = study(spark, sf_dir)
    lazy = Study(stored.src, CONFIG)
    assert pairs(lazy("cohort_counts")) == pairs(stored("cohort_counts"))


def test_step_counts_equal_the_steps(spark, sf_dir):
    s = study(spark, sf_dir)
    for row in diagnosis_counts(s).collect():
        table = s(row.table_name)
        assert row.total_count == table.count()
        assert row.pat_count == table.select("pat_id").distinct().count()
