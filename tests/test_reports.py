"""Reports of chosen orders: texts of the others are left out before they are shuffled."""

import re

import pytest
from pyspark.sql import functions as F

from cohortforge import Study
from cohortforge import operators as O
from cohortforge.plans.orders import comments, report_lines
from cohortforge.sources import from_frames
from testbed.sources import CONFIG

BLOOM = "spark.sql.optimizer.runtime.bloomFilter."
LONG = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    BLOOM + "applicationSideScanSizeThreshold": "1",
}


@pytest.fixture
def long_tables(spark):
    """Joins as of long tables: none is broadcast, and their scans are filtered."""
    before = {name: spark.conf.get(name, None) for name in LONG}
    for name, value in LONG.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def sources(spark, tmp_path):
    """Texts of people, repeated for each of their orders, and texts of orders."""

    def table(name, layout, rows):
        spark.createDataFrame(rows, layout).write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(layout).parquet(f"{tmp_path}/{name}")

    texts = table("texts", "person long, words string", [(k % 30 if k % 9 else None, f"text {k}" if k % 7 else "  ") for k in range(80)])
    made = table("made", "made long, by long", [(k if k % 13 else None, k % 31) for k in range(300)] + [(4, 4), (None, 4)])
    own = table("own", "of long, words string", [(k % 300, f"own {k}") for k in range(0, 600, 7)] + [(None, "no order")])
    lines = texts.join(made, F.col("by") == F.col("person")).select(F.col("made").alias("id"), F.lit(1).alias("line"), F.concat(F.lit("a "), "words").alias("text"))
    lines = lines.union(own.select("of", F.lit(2), "words"))
    chosen = [(f"p{k % 3}", f"A{k}" if k % 4 else None, k, 3) for k in [*range(0, 300, 17), 4, 4]] + [("p1", "A", None, 3)]
    return lines, table("chosen", "pat_id string, acc_num string, order_proc_id long, order_type_c int", chosen)


def study_of(stage, frame, **tables):
    s = Study(from_frames(tables), CONFIG)
    s._built[stage] = frame
    return s


def pruned(df, table):
    """Whether the scan of a table is filtered by the keys of the other side."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return any(re.search(rf"Filter .*might_contain.*{table}#\d+L", line) for line in plan.splitlines())


@pytest.mark.parametrize("kind", ["narrative", "impression"])
def test_reports_are_pruned_by_order_before_their_texts_are_joined(long_tables, sources, kind):
    lines, chosen = sources
    table = lines.toDF("order_proc_id", "line", kind)
    s = study_of("imaging_orders", chosen, **{f"order_{kind}": table})
    found = report_lines(s, f"order_{kind}", kind, "x")
    assert pruned(found, "made")
    orders = {tuple(r)[:3] for r in chosen.collect()}
    expected = {(p, a, k, n, t) for k, n, t in map(tuple, table.collect()) for p, a, o in orders if k is not None and k == o and t.strip()}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == expected and len(expected) > 20


def test_comments_are_pruned_by_order(long_tables, sources):
    lines, chosen = sources
    lines = lines.withColumn("more", F.lit(1))
    tables = {
        "order_res_comp_cmt": lines.toDF("order_id", "line_comp", "results_comp_cmt", "line_comment"),
        "order_res_comment": lines.toDF("order_id", "line", "results_cmt", "line_comment"),
    }
    found = comments(study_of("order_procedures", chosen, **tables), 3, "m")
    assert pruned(found, "made")
    ids = {r.order_proc_id for r in chosen.collect()} - {None}
    expected = {(mark, k, n, t, c) for mark in (1, 2) for k, n, t, c in map(tuple, lines.collect()) if k in ids and t.strip()}
    assert {tuple(r) for r in found.collect()} == expected


@pytest.mark.parametrize("kind", ["long", "int", "string", "double"])
def test_keys_of_any_type_choose_rows(spark, long_tables, tmp_path, kind):
    spark.createDataFrame([(k,) for k in [-5, 0, 3, None, 3]], "k long").select(F.col("k").cast(kind)).write.parquet(f"{tmp_path}/keys")
    rows = spark.range(-20, 20).select(F.col("id").cast(kind).alias("k"), F.lit("x").alias("v"))
    rows.union(spark.range(1).select(F.lit(None).cast(kind), F.lit("x"))).write.parquet(f"{tmp_path}/rows")
    found = O.among(spark.read.parquet(f"{tmp_path}/rows"), spark.read.parquet(f"{tmp_path}/keys"), "k")
    assert sorted(int(float(r.k)) for r in found.collect()) == [-5, 0, 3]
