"""Long tables dealt out by a key once, and joins that leave them there."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cohortforge import operators as O
from cohortforge.session import keep_dealt
from testbed.sources import ViewSources
from testbed.views import BASE_TABLES

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
    "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)
ORDERS = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string"
)


@pytest.fixture
def tables(spark, tmp_path):
    random.seed(5)
    day = datetime(1997, 5, 1)
    orders = [(k, k % 40 if k % 11 else None, "FOP"[k % 3], 100.0 * k, day, "5-LOW") for k in range(300)]
    lines = [
        (random.choice([None, *range(310)]), k % 50, k % 9, 1 + k % 7, 1.0, 2.5, 0.1, 0.0, "ANR"[k % 3], "F", day)
        for k in range(900)
    ]
    lines += lines[:40]
    for name in BASE_TABLES:
        made = {"lineitem": (lines, LINES), "orders": (orders, ORDERS)}.get(name, ([(1,)], "k int"))
        spark.createDataFrame(*made).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def shuffled(spark):
    """Joins as of long tables: none is broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    keep_dealt(spark)
    yield
    for name in (*names, "spark.sql.requireAllClusterKeysForCoPartition"):
        spark.conf.unset(name)


def exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange " in line]


def results_of_orders(src):
    orders = src("order_proc").select("order_proc_id", "proc_code")
    return src("order_results").select("order_proc_id", "pat_id", "line", "ord_value").join(orders, "order_proc_id")


def test_a_second_view_reads_tables_dealt_out_by_order(spark, tables, shuffled, tmp_path):
    plain, landed = ViewSources(spark, tables), ViewSources(spark, tables, str(tmp_path / "landed"))
    assert exchanges(results_of_orders(plain))
    assert not any("/landed/" in f for f in landed("order_results").inputFiles())
    for name in ("pat_enc_dx", "order_results", "order_proc", "pat_enc", "hsp_acct_dx_list"):
        assert all("/landed/" in f for f in landed(name).inputFiles())
        assert landed(name).dtypes == plain(name).dtypes
        assert sorted(map(str, landed(name).collect())) == sorted(map(str, plain(name).collect()))
    found = results_of_orders(landed)
    assert not exchanges(found) and not exchanges(found.distinct())
    assert sorted(map(str, found.collect())) == sorted(map(str, results_of_orders(plain).collect()))


def test_rows_dealt_out_by_order_are_kept_there_when_people_choose(spark, tables, shuffled, tmp_path):
    landed = ViewSources(spark, tables, str(tmp_path / "landed"))
    landed("order_results")
    rows = results_of_orders(landed)
    people = spark.createDataFrame([(str(k),) for k in range(0, 40, 3)] + [(None,)], "pat_id string")
    chosen = O.among_dealt(rows, people, "pat_id", "order_proc_id")
    assert sorted(map(str, chosen.collect())) == sorted(map(str, O.among(rows, people, "pat_id").select(*rows.columns).collect()))
    assert chosen.columns == rows.columns
    wide = [line for line in exchanges(chosen.distinct()) if "ord_value" in line]
    assert not wide and "line" not in "".join(exchanges(chosen.distinct()))


def test_marks_travel_as_bits(spark):
    random.seed(7)
    rows = [(random.choice([None, 1, 2, 3]), random.choice([None, *range(70)])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, v int")
    merged = O.merge_flags(df, ["k"], {f"m{n}": F.col("v") == n for n in range(70)})
    assert merged.dtypes == [("k", "int"), *((f"m{n}", "boolean") for n in range(70))]
    for found in merged.collect():
        seen = {v for k, v in rows if k == found.k}
        assert [found[f"m{n}"] for n in range(70)] == [n in seen for n in range(70)]
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bit_or(") == 2 and "max(" not in plan


def test_problems_are_shuffled_for_one_list_of_staff(spark, sf_dir, shuffled):
    """Staff get their specialties before the problems, many of which name one of them."""
    from cohortforge.study import STAGES, Study
    from testbed.sources import CONFIG

    s = Study(ViewSources(spark, sf_dir), CONFIG)
    plan = STAGES["problem_list"](s)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join LeftOuter" in line and ("prov_id" in line or "entry_user_id" in line)]
    assert [("entry_user_id" in line) for line in joins] == [True, False]


def test_chosen_medications_are_a_stored_list(spark, sf_dir, tmp_path):
    """Of a stored list Spark knows the size: the orders are not shuffled to meet a short one."""
    from cohortforge.sources import StageStore
    from cohortforge.study import Study
    from testbed.sources import CONFIG

    s = Study(ViewSources(spark, sf_dir), CONFIG, StageStore(spark, str(tmp_path)))
    assert all("-med_selection_driver/" in f for f in s("med_selection_driver").inputFiles())
    assert s("med_selection_driver").exceptAll(s.src("med_selection_list")).count() == 0


def test_studies_that_share_a_store_keep_their_own_counts(spark, tmp_path):
    """A study made by a choice saves other versions of stages: the first one's counts stay."""
    from cohortforge import sources as S
    from cohortforge.study import Study
    from testbed.sources import CONFIG

    def made(rows, people):
        spark.createDataFrame([(k, "d", 1, "c") for k in range(rows)], S.LAB_SELECTION).write.parquet(f"{tmp_path}/{rows}/lab_selection_list")
        everyone = spark.createDataFrame([(f"p{k}", k) for k in range(people)], "pat_id string, ethnic_group_c int")
        everyone.write.parquet(f"{tmp_path}/{rows}/patient")
        return Study(S.from_parquet(spark, f"{tmp_path}/{rows}"), CONFIG, store)

    store = S.StageStore(spark, str(tmp_path))
    first, second = made(5, 3), made(8, 4)
    assert first.rows("lab_selection_driver") == 5 and second.rows("lab_selection_driver") == 8
    assert first.rows("lab_selection_driver") == 5
