"""Plans, files and the shape of a whole study."""

import pytest
from pyspark.sql import functions as F

from cohortforge import Study
from cohortforge import sources as S
from cohortforge.operators import check_private
from cohortforge.config import StudyConfig
from cohortforge.plans.extracts import IDENTIFIED
from cohortforge.plans.release import export, extract_names, load_keys, save_keys
from testbed.sources import CONFIG, ViewSources, stage_folder, study


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def fresh(s: Study, *stored: str) -> Study:
    """A study without a store that takes some stages over."""
    for name in stored:
        s(name)
    out = Study(s.src, CONFIG)
    out.reuse(s, list(stored))
    return out


def jobs(spark) -> int:
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup("built"))


def test_building_stages_starts_no_job(spark, sf_dir):
    """What a plan looks like depends on no count and no size taken while it is built."""
    s = study(spark, sf_dir)
    lazy = fresh(s, "cohort", "encounters")
    for name in ("pat_enc_dx", "order_results", "hsp_acct_px_list", "measurement"):
        s.src(name)
    spark.sparkContext.setJobGroup("built", "stages under test")
    try:
        for name in ("first_dx_date", "coded_lab_pull", "procedures_icd", "masked_code_counts"):
            lazy(name)
        assert jobs(spark) == 0
        lazy("masked_code_counts").count()
        assert jobs(spark) > 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_detail_table_is_read_once(spark, sf_dir):
    s = study(spark, sf_dir)
    medications = optimized(fresh(s, "cohort")("all_medications"))
    # orders, their dispensing and their administrations are derived from one table each
    assert sum("Relation [l_orderkey" in line for line in medications.splitlines()) == 3
    assert "LeftAnti" not in medications
    marks = optimized(fresh(s, "cohort", "patient_table", "encounters")("diagnosis_marks"))
    assert sum("Union" in line for line in marks.splitlines()) == 3  # sources, editions, a view
    labs = optimized(fresh(s, "select_labs", "patient_table")("extract_labs"))
    assert sum("Aggregate [order_proc_id" in line for line in labs.splitlines()) == 0


def test_a_store_needs_a_folder_and_repeats_a_failed_write(spark, tmp_path):
    for missing in (None, ""):
        with pytest.raises(ValueError, match="folder"):
            S.StageStore(spark, missing)
    store = S.StageStore(spark, str(tmp_path))
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("int").alias("x"))
    with pytest.raises(Exception, match="no"):
        store.save(broken, "part")
    assert store.save(spark.range(3), "part").count() == 3
    store.release()
    assert list(tmp_path.iterdir()) == []


def test_a_salt_is_required():
    with pytest.raises(ValueError, match="salt"):
        StudyConfig(CONFIG.window_start, CONFIG.window_end, CONFIG.as_of, "")


def test_keys_outlive_new_patients(spark, sf_dir, tmp_path):
    """A release with more patients changes no earlier id, of people, providers or encounters."""
    s = study(spark, sf_dir)
    few = s("cohort").where("hash(pat_id) % 3 = 0")
    first = fresh(s, "encounters")
    first._built["cohort"] = few
    first._built["procedure_fact"] = s("procedure_fact")
    first._built["problem_list"] = s("problem_list")
    first._built["encounters"] = s("encounters").join(few.select("pat_id"), "pat_id", "left_semi")
    save_keys(first, str(tmp_path))
    keys = load_keys(spark, str(tmp_path))
    second = Study(s.src, CONFIG, keys=keys)
    stored = ["cohort", "encounters", "procedure_fact", "problem_list", "patient_table"]
    for name in stored:
        s(name)
    second.reuse(s, stored)
    for stage, name in (("study_id_map", "study_id"), ("provider_key", "prov_study_id"), ("encounter_key", "encounter_id")):
        later, earlier = second(stage), keys[name]
        assert earlier.exceptAll(later.select(earlier.columns)).count() == 0
        ids = [r[name] for r in later.select(name).collect()]
        assert sorted(ids) == list(range(1, len(ids) + 1)) and len(ids) > earlier.count() > 0


def test_two_employee_records_count_a_patient_once(spark, sf_dir):
    s = study(spark, sf_dir)
    doubled = s("providers").groupBy("provider_id").count().where("count > 1").count()
    assert doubled
    in_table = s("patient_table").join(
        s("providers").select(F.col("provider_id").alias("cur_pcp_prov_id")), "cur_pcp_prov_id", "left_semi"
    )
    panels = s.src("lz_clarity_patient").select(F.col("cur_pcp_prov_id").alias("p")).distinct()
    seen = in_table.join(panels, F.col("cur_pcp_prov_id") == F.col("p"), "left_semi")
    assert s("panel_age").agg(F.sum("hiv_patients")).first()[0] == seen.count()


def test_bad_driver_files_stop_the_read(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("icd_type,icd_code,icd_desc,dx_flag\nnine,a,b,c\n")
    with pytest.raises(Exception, match="(?i)malformed|cast|bad"):
        S.read_driver(spark, str(tmp_path / "bad.csv"), S.DX_CODES).collect()
    (tmp_path / "lines.csv").write_text('a,b,c,d\n9,"x ","two\nlines",T\n9,x,"two\nlines",T\n')
    got = S.read_driver(spark, str(tmp_path / "lines.csv"), S.DX_CODES).collect()
    assert [tuple(r) for r in got] == [(9, "x", "two\nlines", "T")]


def test_blank_text_is_missing(spark):
    df = spark.createDataFrame([("", 1), (" ", 2), ("a", 3)], "t string, n int")
    assert [r.t for r in S.blank_is_null(df).orderBy("n").collect()] == [None, " ", "a"]


def test_plans_stay_in_the_jvm(spark, sf_dir):
    s = study(spark, sf_dir)
    for name in ("coded_lab_pull", "dx_primary", "all_medications", "masked_code_counts"):
        text = plan(fresh(s, "cohort", "patient_table")(name))
        assert "Python" not in text and "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_anti_joins_and_pushdown(spark, sf_dir):
    s = study(spark, sf_dir)
    assert "LeftAnti" in plan(s("procedures_cpt_hosp"))
    assert "LeftAnti" in plan(s("cohort_lab_only"))
    labs = plan(fresh(s)("coded_lab_pull"))
    assert "PushedFilters: [IsNotNull(" in labs


def test_extracts_are_private(spark, sf_dir):
    s = study(spark, sf_dir)
    for name in extract_names():
        if name in IDENTIFIED:
            with pytest.raises(ValueError):
                check_private(s("patient_table"))
        else:
            check_private(s(name))


def test_cohort_types_partition_the_cohort(spark, sf_dir):
    s = study(spark, sf_dir)
    found = s("all_found")
    assert found.count() == found.select("pat_id").distinct().count()
    assert s("cohort").join(s("all_found"), "pat_id", "left_anti").count() == 0


def test_export_and_release(spark, sf_dir):
    store = S.StageStore(spark, stage_folder(spark))
    s = Study(ViewSources(spark, sf_dir), CONFIG, store)
    names = ["extract_social_history", "extract_disclosure_list"]
    paths = export(s, f"{store.root}/out", names)
    back = spark.read.csv(paths[0], header=True, escape='"')
    assert back.count() == s("extract_social_history").count() > 0
    assert back.columns == s("extract_social_history").columns
    assert any(path.endswith("-cohort") for path in s.release())
    assert s.release() == []


def test_driver_file_layout(spark, sf_dir):
    root = S.StageStore(spark, stage_folder(spark)).root
    rows = [(" L-1 ", 'a "quoted", name', None, "2"), (None, "x", "", "")]
    S.write_csv(spark.createDataFrame(rows, S.LAB_RULES), f"{root}/rules")
    back = S.read_driver(spark, f"{root}/rules", S.LAB_RULES)
    got = {tuple(r) for r in back.collect()}
    assert got == {("L-1", 'a "quoted", name', None, "2"), (None, "x", None, None)}


def test_ledger_covers_the_stages(spark, sf_dir):
    rows = study(spark, sf_dir)("qa_ledger").where(F.col("table_name") == "cohort").collect()
    assert len(rows) == 1 and rows[0].pat_count == rows[0].total_count
    assert rows[0].load_time is not None
