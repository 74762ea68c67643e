"""How stages are put together for large tables."""

import re
from datetime import date, datetime

from cohortforge import Study, StudyConfig
from cohortforge.session import PARTITION_BYTES, RUNTIME_SETTINGS, partition_by_size
from cohortforge.sources import from_frames
from testbed.sources import LISTS, ViewSources

CFG = StudyConfig(window_start=date(2020, 1, 1), window_end=date(2020, 12, 31), as_of=date(2021, 1, 1), salt="s")


def test_shuffle_partitions_grow_with_the_inputs(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    least = spark.conf.get("spark.sql.shuffle.partitions")
    partition_by_size(spark, 1000 * PARTITION_BYTES)
    assert spark.conf.get(name) == "1000"
    partition_by_size(spark, 1)
    assert spark.conf.get(name) == least
    for setting in ("advisoryPartitionSizeInBytes", "fileCompressionFactor"):
        assert any(setting in known for known in RUNTIME_SETTINGS)


def lab_sources(spark):
    day = datetime(2020, 5, 1)
    rows = lambda text, *found: spark.createDataFrame(list(found), text)
    return from_frames(
        {
            "lnc_db_main": rows("record_id long, lnc_code string", (1, "L-1")),
            "clarity_component": rows(
                "component_id long, name string, common_name string, default_lnc_id long, loinc_code string",
                (7, "Component", "common", 1, "OLD"),
                (8, "Other", "common", None, "L-9"),
            ),
            "lab_rule_list": rows("loinc string, step string", ("L-1", "2"), ("L-1", "2")),
            "order_proc": rows(
                "order_proc_id long, pat_id string, proc_id long, proc_code string, description string, "
                "order_time timestamp, result_time timestamp, order_status_c long, order_type_c long",
                (10, "a", 1, "PC", "Order", day, day, 5, 7),
                (11, "a", 1, "PC", "Order", day, day, 5, 8),
            ),
            "order_results": rows(
                "order_proc_id long, pat_id string, pat_enc_csn_id long, component_id long, result_date timestamp, "
                "result_time timestamp, ord_value string, ord_num_value decimal(20, 10), reference_unit string, "
                "ref_normal_vals string, reference_low string, reference_high string, result_flag_c long",
                *((k, "a", 1, c, day, day, "POSITIVE", None, "u", "n", "0", "1", 0) for k in (10, 11) for c in (7, 8)),
            ),
            "order_proc_2": rows("order_proc_id long, specimn_taken_time timestamp", (10, day)),
            "patient": rows("pat_id string", ("a",)),
        },
        lambda name: None,
    )


def test_results_meet_their_orders_before_the_components(spark):
    pulled = Study(lab_sources(spark), CFG)("coded_lab_pull")
    assert [(r.order_proc_id, r.component_id, r.step) for r in pulled.collect()] == [(10, 7, "2")]
    plan = pulled._jdf.queryExecution().optimizedPlan().toString()
    joins = re.findall(r"Join Inner, \(+(component_id|order_proc_id)#", plan)
    assert joins[0] == "component_id"  # the uppermost: the last join


def test_short_lists_are_landed_as_they_are(spark, sf_dir, tmp_path):
    landed, plain = ViewSources(spark, sf_dir, str(tmp_path)), ViewSources(spark, sf_dir)
    for name in LISTS:
        assert landed(name).dtypes == plain(name).dtypes
        assert all(f"/{name}/" in file for file in landed(name).inputFiles())
        assert sorted(map(str, landed(name).collect())) == sorted(map(str, plain(name).collect()))
