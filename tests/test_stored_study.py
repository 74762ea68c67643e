"""Stored studies: the stage graph, resuming, counts kept at writing, and published files."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortforge import Study
from cohortforge import operators as O
from cohortforge import sources as S
from cohortforge.plans import quality
from cohortforge.plans.release import export, manifest, prune, select, verify
from cohortforge.sources import StageStore
from cohortforge.study import REGISTERED
from testbed.sources import CONFIG, ViewSources, stage_folder, study


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, sf_dir, tmp_path):
    def make(run="release", cls=StageStore, config=CONFIG):
        return Study(ViewSources(spark, sf_dir), config, cls(spark, str(tmp_path), run))

    return make


class Broken(StageStore):
    """A driver that is lost while a stage is written."""

    def save(self, df, name, version=None, sets=None, by=None):
        if name == "cohort":
            df = df.withColumn("pat_id", F.raise_error(F.lit("lost")).cast("string"))
        return super().save(df, name, version, sets, by)


def names(store):
    return {p.rpartition("-")[2] if p.endswith("-people") else p.rpartition("/")[2].partition("-")[2] for p in store.written}


def test_a_second_run_writes_only_what_is_not_complete(stored):
    first = stored(cls=Broken)
    with pytest.raises(Exception, match="lost"):
        first("patient_table")
    done = set(first.store.stored)
    assert {"first_dx_date", "coded_lab_pull", "all_found"} <= done and "cohort" not in done
    second = stored()
    assert second("patient_table").count() > 0
    assert not done & {n for n in names(second.store) if n != "people"}
    assert {"cohort", "patient_table"} <= names(second.store)
    third = stored()
    assert third("patient_table").exceptAll(second("patient_table")).count() == 0
    assert third.store.written == []


def test_another_configuration_is_another_version(stored):
    one, other = stored(), stored(config=CONFIG.__class__(**{**CONFIG.__dict__, "adult_age": 40}))
    assert one("cohort").count() == other("cohort").count()
    assert one.version("cohort") != other.version("cohort")
    again = stored()
    again("cohort")
    assert again.version("cohort") == one.version("cohort") and again.store.written == []


def test_changed_sources_make_only_their_dependents_anew(spark, tmp_path):
    def write(name, rows, layout):
        spark.createDataFrame(rows, layout).write.mode("overwrite").parquet(str(tmp_path / name))

    write("lz_clarity_dept", [(1, "d", "s", 1)], "department_id int, department_name string, specialty string, primary_care int")
    write("dx_code_list", [(9, "a", "b", "T")], S.DX_CODES)
    run = lambda: Study(S.from_parquet(spark, str(tmp_path)), CONFIG, StageStore(spark, str(tmp_path), "run"))
    first = run()
    first("primary_care_depts"), first("dx_code_driver")
    write("dx_code_list", [(9, "a", "b", "T"), (10, "c", "d", "T")], S.DX_CODES)
    second = run()
    assert second("dx_code_driver").count() == 2 and second("primary_care_depts").count() == 1
    assert names(second.store) == {"dx_code_driver"}


def test_a_choice_makes_only_its_dependents_anew(spark, sf_dir, tmp_path):
    s = study(spark, sf_dir)
    for name in ("extract_labs", "extract_medications", "cohort_counts", "panel_age", "all_labs"):
        s(name)
    for name, layout in (("meds", S.MED_SELECTION), ("labs", S.LAB_SELECTION)):
        S.write_csv(spark.createDataFrame([], layout), str(tmp_path / name))
    chosen = select(s, spark, str(tmp_path / "meds"), str(tmp_path / "labs"))
    lost = set(s.built) - set(chosen.built)
    assert {"select_labs", "select_medications", "extract_labs", "extract_medications", "lab_selection_driver"} <= lost
    assert not lost & {"cohort_counts", "panel_age", "all_labs", "all_medications", "cohort", "vitals"}
    for name in set(s.built) - lost:
        assert not {"med_selection_list", "lab_selection_list"} & s.sources_of(name)


def test_the_ledger_reads_no_stage_again(spark, sf_dir):
    s = study(spark, sf_dir)
    s("qa_ledger")
    parts = quality.from_writing(s)
    for part in parts:
        for file in part.inputFiles():
            assert "-people/" in file or any(f"-{n}/" in file for n in ("dx_code_driver", "dx_driver_map", "lab_rule_driver"))
    rows = lambda found: sorted(str(tuple(r)) for p in found for r in p.select("table_name", "pat_count", "total_count", "description").collect())
    assert rows(parts) == rows(quality.from_rows(s))
    assert all(s.rows(n) == s(n).count() for n in ("cohort", "vitals", "all_labs"))


def test_attrition_reads_only_sets(spark, sf_dir):
    s = study(spark, sf_dir)
    for name in ("attrition", "stage_profile"):
        files = s(name).inputFiles()
        assert files and all("-people/" in f or "-patient_table/" in f or "-person_number/" in f for f in files)
    rows = s("attrition").orderBy("step").collect()
    assert rows[0].kept == rows[0].people > 0 and all(r.lost >= 0 for r in rows)


def test_counts_add_up_over_releases(spark):
    """People of two releases together, from their sets alone; numbers are kept, ids without one too."""
    random.seed(3)
    ids = [f"p{k}" for k in range(70_000)]
    old, new = random.sample(ids, 3000), random.sample(ids, 4000)
    people = spark.createDataFrame([(i,) for i in ids], "pat_id string")
    first = O.dense_key(people.where("hash(pat_id) % 2 = 0"), "pat_id", "number", "s")
    numbers = O.dense_key(people.where("hash(pat_id) % 10 <> 3"), "pat_id", "number", "s", existing=first)
    make = lambda rows, known: O.people_sets(spark.createDataFrame([(i,) for i in rows + rows[:9] + [None]], "pat_id string"), "pat_id", known)
    sets = make(old, numbers).withColumn("r", F.lit(1)).unionByName(make(new, numbers).withColumn("r", F.lit(2)))
    assert [r["pat_count"] for r in O.count_sets(sets, ["r"]).orderBy("r").collect()] == [3000, 4000]
    assert tuple(O.count_sets(sets, []).first()) == (len({*old, *new}), 7020)
    assert O.count_common(sets.withColumn("g", F.lit(1)), ["g"], "r", 2).first()["pat_count"] == len({*old} & {*new})
    assert sets.where("loose is not null").count() > 0


def test_sets_of_parts_and_of_nothing(spark):
    numbers = spark.createDataFrame([("a", 1), ("b", 32768), ("c", 32769)], "pat_id string, number long")
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 0), ("c", 5), ("z", 1), (None, 4)], "pat_id string, n int")
    sets = O.people_sets(df, "pat_id", numbers, {"n": F.col("n"), "rows": F.lit(1), "none": F.lit(0)})
    counted = {r["part"]: (r["pat_count"], r["total_count"]) for r in O.count_sets(sets, ["part"]).collect()}
    assert counted == {"n": (3, 13), "rows": (4, 6)}
    assert O.people_sets(df.limit(0), "pat_id", numbers).collect() == []


# --- layout -----------------------------------------------------------------


@pytest.fixture
def never_broadcast(spark):
    """Joins as they are where no side is small, and settings to lower what is large."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {}

    def put(settings):
        before.update({k: spark.conf.get(k, None) for k in settings if k not in before})
        for k, v in settings.items():
            spark.conf.set(k, v)

    put(changed)
    yield put
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_stored_stages_join_without_a_shuffle(spark, sf_dir, tmp_path, never_broadcast):
    make = lambda buckets: Study(ViewSources(spark, sf_dir), CONFIG, StageStore(spark, str(tmp_path), f"r{buckets}", buckets))
    dealt, plain = make(4), make(0)

    def joined(s):
        return s("vitals").join(s("patient_table").select("pat_id", "study_id"), "pat_id")

    assert "Exchange" not in physical(joined(dealt)) and "SortMergeJoin" in physical(joined(dealt))
    assert "Exchange" in physical(joined(plain))
    assert joined(dealt).count() == joined(plain).count() > 0
    again = make(4)  # as a new session would find them
    for done in dealt.store.stored.values():
        if done.buckets:
            spark.sql(f"drop table if exists {again.store._table(done.path)}")
    assert "Exchange" not in physical(joined(again)) and again.store.written == []
    assert joined(again).count() == joined(plain).count()
    assert dealt.store.release()


def test_the_window_prunes_landed_tables(spark, sf_dir, tmp_path):
    views = ViewSources(spark, sf_dir)
    landed = {"pat_enc_dx": "contact_date", "order_proc": "order_time", "hsp_admit_diag": "pat_enc_date_real"}
    for name, column in landed.items():
        S.land(views(name), column, str(tmp_path / name), spread=2)
    sources = S.from_frames({n: spark.read.parquet(str(tmp_path / n)) for n in landed}, views)
    s, plain = Study(sources, CONFIG), study(spark, sf_dir)
    for name in ("cohort", "patient_table", "encounters"):
        plain(name)
    s.reuse(plain, ["cohort", "patient_table", "encounters"])
    for name in ("first_dx_date", "coded_lab_pull", "diagnosis_fact"):
        found, expected = s(name), plain(name)
        assert found.columns == expected.columns
        assert found.exceptAll(expected).count() == expected.exceptAll(found).count() == 0
    text = physical(s("first_dx_date"))
    assert "PartitionFilters: [isnotnull(contact_date_month" in text and "1996-03-01" in text
    assert "PartitionFilters: [isnotnull(order_time_month" in physical(s("coded_lab_pull"))
    from cohortforge.plans.diagnoses import admit_dx

    assert "dynamicpruningexpression(pat_enc_date_real_slice" in physical(admit_dx(s))


def test_rows_without_a_time_are_landed_too(spark, tmp_path):
    df = spark.sql("select * from values (1, timestamp '2020-01-31 10:00:00'), (2, null), (3, timestamp '2020-02-01') as t(k, ts)")
    assert S.land(df, "ts", str(tmp_path / "t")) == "ts_month"
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted((r["k"], str(r["ts_month"])) for r in back.collect()) == [(1, "2020-01-01"), (2, "None"), (3, "2020-02-01")]


def test_a_filter_of_the_peoples_keys_goes_before_the_shuffle(spark, sf_dir, never_broadcast):
    """Past the broadcast threshold rows of other people are not shuffled; the result is the same."""
    s = study(spark, sf_dir)
    few = O.first_event(s("cohort"), "pat_id", "first_hiv_dx_date", F.col("pat_id").startswith("1")).select("pat_id")
    few = s.store.save(few, "few_people")
    labs = s.store.save(s.src("order_results").select("pat_id", "order_proc_id"), "all_results")
    expected = labs.join(few, "pat_id", "left_semi").count()
    sizes = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"

    def shuffled(limit):
        never_broadcast({sizes: limit, "spark.sql.adaptive.enabled": "false"})
        kept = O.among(labs, few, "pat_id")
        assert kept.count() == expected
        return ("might_contain" in physical(kept)), kept

    without, _ = shuffled("1TB")
    with_filter, kept = shuffled("1")
    assert with_filter and not without
    before_the_shuffle = kept._jdf.queryExecution().executedPlan().toString()
    assert before_the_shuffle.index("Exchange hashpartitioning(pat_id") < before_the_shuffle.index("might_contain")
    assert expected < labs.count() / 2


# --- merges and changes -----------------------------------------------------


def test_an_ambiguous_merge_stops(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    rows = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    merged = lambda source: O.upsert(target, source, ["k"], {"v": F.col("_new_v")})
    with pytest.raises(Exception, match=r'source rows differ for one key.*"k":1'):
        merged(rows((1, "x"), (1, "y"))).collect()
    found = merged(rows((1, "x"), (1, "x"), (3, "p"), (3, "q"), (None, "m"), (None, "o"))).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, [(1, "x"), (2, "b"), (None, "n"), (3, "p"), (3, "q"), (None, "m"), (None, "o")]))


def test_changes_of_a_table(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.0), (None, "n", 0.0)], "k int, v string, w double")
    new = spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "c"), (4, 4.0, "d"), (None, 0.0, "m")], "k int, w double, v string")
    found = {r["k"]: (r["change"], r["columns"]) for r in O.table_changes(old, new, ["k"]).collect()}
    assert found == {2: ("updated", ["v", "w"]), 3: ("deleted", None), 4: ("inserted", None), None: ("updated", ["v"])}
    with pytest.raises(Exception, match="a key repeats after the change"):
        O.table_changes(old, new.union(new), ["k"]).collect()
    assert O.table_changes(old, old.withColumn("x", F.lit(None).cast("int")), ["k"]).collect() == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4), st.lists(st.booleans(), min_size=3, max_size=3)), max_size=12))
def test_rules_and_their_combinations(spark, rows):
    df = spark.createDataFrame([(p, e, *bits) for p, e, bits in rows], "p int, e int, a boolean, b boolean, c boolean")
    found = {(r["kind"], r["rules"]): (r["events"], r["people"]) for r in O.rule_counts(df, {n: F.col(n) for n in "abc"}, "p", ["e"]).collect()}
    events, people = {}, {}
    for p, e, bits in rows:
        met = {n for n, bit in zip("abc", bits) if bit}
        if met:
            events.setdefault((p, e), set()).update(met)
            people.setdefault(p, set()).update(met)
    expected = {}
    for n in "abc":
        if any(n in m for m in events.values()):
            expected["rule", n] = (sum(n in m for m in events.values()), sum(n in m for m in people.values()))
    for m in map(frozenset, [*events.values(), *people.values()]):
        expected["combination", "+".join(sorted(m))] = (sum(x == m for x in events.values()), sum(x == m for x in people.values()))
    assert found == expected


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 2), st.lists(st.integers(1, 30), min_size=1, max_size=5), max_size=3))
def test_hidden_cells_do_not_follow_from_totals(spark, groups):
    rows = [(g, f"c{k}", n) for g, cells in groups.items() for k, n in enumerate(cells)]
    cells = O.suppress(spark.createDataFrame(rows, "g int, c string, n int"), ["g"], "c", "n", 10).collect()
    assert len(cells) == len(rows)
    for g, values in groups.items():
        mine = [r for r in cells if r["g"] == g]
        hidden = [r["n"] for r in mine if r["shown"] is None]
        assert all(r["shown"] in (None, r["n"]) and (r["n"] >= 10 or r["shown"] is None) for r in mine)
        assert len({r["total"] for r in mine}) == 1
        total = mine[0]["total"]
        assert total in (None, sum(values))
        if min(values) >= 10:
            assert not hidden and total == sum(values)
        elif total is not None:  # what is left for the hidden cells is not one cell, nor a small sum
            left = total - sum(r["shown"] or 0 for r in mine)
            assert len(hidden) >= 2 and left == sum(hidden) >= 10
            if len(hidden) > 2 and max(hidden) >= 10:  # none was hidden that need not be
                assert sum(hidden) - max(hidden) < 10


# --- contracts ----------------------------------------------------------------


LAYOUT = (O.Field("id", "long", required=True), O.Field("day", "date"), O.Field("note", longest=3))


def test_rows_that_do_not_fit_are_kept_with_reasons(spark):
    rows = [("1", "2020-01-31", "abc"), ("x", "2020-02-30", "abcd"), (None, None, None), (" 7 ", None, "")]
    judged = O.judged(spark.createDataFrame(rows, "id string, day string, note string"), LAYOUT)
    assert {r["reasons"][0] if len(r["reasons"]) == 1 else tuple(r["reasons"]) for r in O.rejected(judged).collect()} == {
        "id is missing",
        ("id is not long", "day is not date", "note is longer than 3"),
    }
    good = O.accepted(judged, LAYOUT)
    assert dict(good.dtypes) == {"id": "bigint", "day": "date", "note": "string"}
    assert sorted(r["id"] for r in good.collect()) == [1, 7]


def test_strict_mode_stops(spark):
    df = spark.createDataFrame([("1", None, "a"), (None, None, "b")], "id string, day string, note string")
    assert O.enforced(df.where("id = 1"), LAYOUT).count() == 1
    with pytest.raises(Exception, match="a row does not fit: id is missing"):
        O.enforced(df, LAYOUT).collect()


# --- published files ------------------------------------------------------------


def test_a_failed_export_leaves_the_last_release(spark, sf_dir, tmp_path):
    s, folder = study(spark, sf_dir), str(tmp_path)
    names = ["extract_social_history", "extract_disclosure_list"]
    export(s, folder, names)
    before = manifest(spark, folder)
    assert [tuple(r) for r in verify(spark, folder).select("extract", "whole").orderBy("extract").collect()] == [(n, True) for n in sorted(names)]
    broken = Study(s.sources, CONFIG)
    broken.reuse(s, s.built)
    broken._built["extract_disclosure_list"] = s("extract_disclosure_list").withColumn("study_id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        export(broken, folder, names)
    assert manifest(spark, folder) == before and verify(spark, folder).where("not whole").count() == 0
    assert len(prune(spark, folder)) == 1
    export(s, folder, names[:1])
    after = manifest(spark, folder)
    assert after[names[1]] == before[names[1]] and after[names[0]]["path"] != before[names[0]]["path"]
    back = spark.read.csv(after[names[0]]["path"], header=True, escape='"')
    assert back.count() == after[names[0]]["rows"] == s(names[0]).count()


def test_a_changed_file_is_noticed(spark, sf_dir, tmp_path):
    s, folder = study(spark, sf_dir), str(tmp_path)
    [path] = export(s, folder, ["extract_disclosure_list"])
    assert verify(spark, folder).first()["whole"]
    part = next(p for p in (tmp_path / path.removeprefix(f"{folder}/")).iterdir() if p.suffix == ".csv")
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    part.write_text(part.read_text() + "x\n")
    assert not verify(spark, folder).first()["whole"]


def test_stored_stages_are_those_that_others_read(spark, sf_dir):
    s = study(spark, sf_dir)
    s("qa_ledger")
    for name in s.store.stored:
        assert REGISTERED[name].stored if name in REGISTERED else True
    assert all(n in s.store.stored for n in quality.COUNTED)
    assert stage_folder(spark) is not None
