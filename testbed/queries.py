"""The registered queries: every stage and extract, and each operator on its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortforge import functions as C
from cohortforge import operators as O
from cohortforge import sources as S
from cohortforge.plans.release import export, review, select, verify
from cohortforge.study import NOTES, STAGES, Study
from testbed.oracle import AS_OF, HARMONISED, INCOMPLETE, ORACLE, ledger, statement, within, years
from testbed.sources import CONFIG, study

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Stages listed under their operator's name.
RENAMED = {"flagged_labs": "harmonize_qualitative"}

ROUNDED = ("avg_age", "median_age", "mode_age")
DECIMALS = ("ord_num_value", "harm_num_val")
WITH_DECIMALS = (
    "coded_lab_pull",
    "flagged_labs",
    "all_labs",
    "select_labs",
    "extract_labs",
)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and averages rounded, as the SQL side has them."""
    columns = {}
    for field in df.schema.fields:
        if field.dataType.typeName() == "decimal":
            columns[field.name] = F.col(field.name).cast("double")
        elif field.name in ROUNDED:
            columns[field.name] = F.round(field.name, 6)
    return df.withColumns(columns) if columns else df


def _stage_query(name: str) -> Query:
    return lambda spark, sf_dir: comparable(study(spark, sf_dir)(name))


def _stage_sql(name: str) -> str:
    body = f"select * from st_{name}"
    if name in WITH_DECIMALS:
        casts = ", ".join(f"cast({c} as double) as {c}" for c in DECIMALS)
        body = f"select * replace ({casts}) from st_{name}"
    elif name == "panel_age":
        body = "select * replace ({}) from st_panel_age".format(
            ", ".join(f"round({c}, 6) as {c}" for c in ROUNDED)
        )
    return statement(body)


for _name in STAGES:
    if _name in ORACLE:
        QUERIES[RENAMED.get(_name, _name)] = _stage_query(_name)
        SQL[RENAMED.get(_name, _name)] = _stage_sql(_name)


def query(sql: str) -> Callable[[Callable[[Study, SparkSession], DataFrame]], Query]:
    """Register an operator query under its function's name, with its SQL body."""

    def register(function: Callable[[Study, SparkSession], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(function(study(spark, sf_dir), spark))

        name = function.__name__.removeprefix("q_")
        QUERIES[name] = run
        SQL[name] = statement(sql)
        return run

    return register


# --- count ledger ---------------------------------------------------------

for _name in ("qa_ledger", "extract_counts"):
    # the load time is when the query ran, so it cannot be compared
    QUERIES[_name] = lambda spark, sf_dir: study(spark, sf_dir)("qa_ledger").drop("load_time")
    SQL[_name] = statement(ledger(NOTES))


# --- sources and sinks ----------------------------------------------------


def _file(spark: SparkSession, s: Study, name: str) -> str:
    return f"{s.store.root}/files/{name}"


def _round_trip(spark: SparkSession, s: Study, name: str, layout: str) -> DataFrame:
    """A driver list written as quoted CSV and loaded again."""
    path = _file(spark, s, name)
    S.write_csv(s.src(name), path)
    return S.read_driver(spark, path, layout)


@query("select distinct * from dx_code_list")
def q_load_dx_codes(s, spark):
    return _round_trip(spark, s, "dx_code_list", S.DX_CODES)


@query("select distinct * from lab_rule_list")
def q_load_lab_rules(s, spark):
    return _round_trip(spark, s, "lab_rule_list", S.LAB_RULES)


@query("select distinct * from med_selection_list")
def q_load_med_selection(s, spark):
    return _round_trip(spark, s, "med_selection_list", S.MED_SELECTION)


@query("select distinct * from lab_selection_list")
def q_load_lab_selection(s, spark):
    return _round_trip(spark, s, "lab_selection_list", S.LAB_SELECTION)


@query("select * from patient")
def q_staged_table(s, spark):
    return s.store.save(s.src("patient"), "staged_patient")


def _read_back(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """All columns of a file that `df` was written to; its texts may hold line breaks and quotes."""
    return spark.read.csv(
        path, schema=df.schema, header=True, escape='"', multiLine=True, timestampFormat=S.TIME_FORMAT
    )


@query("from st_extract_narratives")
def q_extract_to_csv(s, spark):
    """An extract with free text written to files and read back whole."""
    path = export(s, f"{s.store.root}/files/csv", ["extract_narratives"])[0]
    return _read_back(spark, s("extract_narratives"), path)


@query("from st_extract_microbiology")
def q_extract_comments_to_csv(s, spark):
    """The same for an extract with times and comments."""
    path = export(s, f"{s.store.root}/files/csv", ["extract_microbiology"])[0]
    return _read_back(spark, s("extract_microbiology"), path)


@query("""
select 'extract_social_history' as extract, count(*) as rows, true as whole from st_extract_social_history
union all
select 'extract_imaging', count(*), true from st_extract_imaging""")
def q_release_manifest(s, spark):
    """Two extracts published one after the other, and their files held against the manifest."""
    folder = f"{s.store.root}/files/published"
    for name in ("extract_social_history", "extract_imaging"):
        export(s, folder, [name])
    return verify(spark, folder).select("extract", "rows", "whole")


@query("""
select 'medication' as kind, medication_id as id, cast(null as bigint) as component, count(*) as n
from st_all_medications
where medication_id in (select medication_id from st_med_review_list) and medication_id % 2 = 0 group by all
union all
select 'lab', proc_id, component_id, count(*) from st_all_labs where component_id % 2 = 0 group by all""")
def q_review_and_select(s, spark):
    """Lists written for review, some rows chosen from the files, and the study with that choice."""
    meds, labs, _ = review(s, f"{s.store.root}/files/review")
    read = {"header": True, "escape": '"', "multiLine": True}
    chosen_meds = spark.read.csv(meds, **read).where("medication_id % 2 = 0").drop("total")
    chosen_labs = spark.read.csv(labs, **read).where("component_id % 2 = 0").drop("total")
    paths = [f"{s.store.root}/files/chosen_{k}" for k in ("meds", "labs")]
    S.write_csv(chosen_meds.select(*_names(S.MED_SELECTION)), paths[0])
    S.write_csv(chosen_labs.select(*_names(S.LAB_SELECTION)), paths[1])
    chosen = select(s, spark, *paths)
    drug = chosen("select_medications").groupBy(F.col("medication_id").alias("id")).count()
    lab = chosen("select_labs").groupBy(F.col("proc_id").alias("id"), "component_id").count()
    parts = [
        drug.select(F.lit("medication"), "id", F.lit(None).cast("long"), "count"),
        lab.select(F.lit("lab"), "id", "component_id", "count"),
    ]
    return parts[0].union(parts[1]).toDF("kind", "id", "component", "n")


def _names(layout: str) -> list[str]:
    return [field.split()[0] for field in layout.split(", ")]


@query("""
with earlier as (
  select pat_id, row_number() over (order by sha256('testbed' || pat_id), pat_id) as study_id
  from st_adult_filter where pat_id in (select cast(c_custkey as varchar) from customer where c_nationkey < 12)),
fresh as (select distinct pat_id from st_adult_filter where pat_id not in (select pat_id from earlier))
select pat_id, study_id from earlier
union all
select pat_id, (select count(*) from earlier)
  + row_number() over (order by sha256('testbed' || pat_id), pat_id) from fresh""")
def q_study_id_map_grown(s, spark):
    """Study ids after a release with fewer patients: theirs are kept, new ones follow."""
    old = s.src.table("customer").where("c_nationkey < 12")
    old = s("adult_filter").join(
        old.select(F.col("c_custkey").cast("string").alias("pat_id")), "pat_id", "left_semi"
    )
    earlier = O.dense_key(old, "pat_id", "study_id", s.cfg.salt)
    later = Study(s.src, s.cfg, keys={"study_id": earlier})
    later.reuse(s, [name for name in s.built if name != "study_id_map"])
    return later("study_id_map").select("pat_id", "study_id")


# --- result, address and code columns on whole tables ---------------------


@query(f"""
select ord_value, harm_sign, harm_text_val, cast(harm_num_val as double) as harm_num_val, count(*) as n
from (select ord_value, {HARMONISED}
  from (select * replace (nullif(ord_value, '') as ord_value) from order_results)) group by all""")
def q_harmonize_numeric(s, spark):
    harm = C.harmonize_numeric(F.col("ord_value"), F.col("ord_num_value"))
    return (
        s.src("order_results")
        .select(
            "ord_value",
            harm.sign.alias("harm_sign"),
            harm.text.alias("harm_text_val"),
            harm.number.alias("harm_num_val"),
        )
        .groupBy("ord_value", "harm_sign", "harm_text_val", "harm_num_val")
        .agg(F.count("*").alias("n"))
    )


@query("""
select ord_value, case when ord_value like '%\\%' escape '\\'
    then cast(regexp_extract(ord_value, '[0-9]+([.][0-9]+)?') as double)
  end as percent, count(*) as n
from (select * replace (nullif(ord_value, '') as ord_value) from order_results) group by all""")
def q_strict_decimals(s, spark):
    harm = C.harmonize_numeric(F.col("ord_value"), F.col("ord_num_value"), strict_decimals=True)
    percent = F.when(F.col("ord_value").endswith("%"), harm.number)
    return (
        s.src("order_results")
        .select("ord_value", percent.alias("percent"))
        .groupBy("ord_value", "percent")
        .agg(F.count("*").alias("n"))
    )


@query(f"select pat_id, {INCOMPLETE} from patient")
def q_incomplete_address(s, spark):
    address = C.incomplete_address(F.col("add_line_1"), F.col("city"), F.col("zip"))
    return s.src("patient").select("pat_id", address.alias("incomplete_address"))


@query("""
select order_med_id, medication_id, case when medication_id <> 800001 then medication_id
  else coalesce(dispensable_med_id, user_sel_med_id) end as used_med_id
from order_med left join order_medinfo using (order_med_id)""")
def q_resolve_med_id(s, spark):
    used = C.resolve_medication(
        F.col("medication_id"), F.col("dispensable_med_id"), F.col("user_sel_med_id"), 800001
    )
    df = s.src("order_med").join(s.src("order_medinfo"), "order_med_id", "left")
    return df.select("order_med_id", "medication_id", used.alias("used_med_id"))


@query(f"select pat_id, {years(AS_OF, 'birth_date')} as age from patient")
def q_age_years(s, spark):
    return s.src("patient").select(
        "pat_id", C.age_years(F.col("birth_date"), CONFIG.as_of).alias("age")
    )


@query(f"""
select count(*) filter (where {within('effective_time')}) as to_midnight,
  count(*) filter (where {within("cast(effective_time as date)")}) as whole_last_day
from clarity_adt""")
def q_study_window(s, spark):
    df = s.src("clarity_adt")
    ts, day = F.col("effective_time"), C.day_of(df, "effective_time")
    return df.agg(
        F.count_if(C.in_window(ts, CONFIG)).alias("to_midnight"),
        F.count_if(C.in_window(day, CONFIG)).alias("whole_last_day"),
    )


# --- operators on their own, over whole test tables -----------------------


@query("""
select o_custkey, min(o_orderdate) as first_date from orders where o_orderstatus = 'F' group by o_custkey""")
def q_first_event(s, spark):
    orders = s.src.table("orders")
    return O.first_event(
        orders, "o_custkey", "o_orderdate", F.col("o_orderstatus") == "F", "first_date"
    )


@query("""
select * from events e where date_trunc('day', ts) = (
  select max(date_trunc('day', x.ts)) from events x where x.user_id = e.user_id)""")
def q_latest_records(s, spark):
    events = s.src.table("events")
    dated = events.withColumn("day", C.day_of(events, "ts"))
    return O.latest_records(dated, "user_id", "day").select(events.columns)


@query("""
select o_custkey from orders where o_orderpriority = '1-URGENT' and o_totalprice > 300000
union select o_custkey from orders where o_orderpriority = '2-HIGH' and o_orderstatus = 'F'""")
def q_rule_events(s, spark):
    priority = F.col("o_orderpriority")
    rules = [
        (priority == "1-URGENT", F.col("o_totalprice") > 300000),
        (priority == "2-HIGH", F.col("o_orderstatus") == "F"),
    ]
    return O.rule_events(s.src.table("orders"), rules, ["o_custkey"])


@query("""
select coalesce(a.k, b.k) as k, case when a.k is not null and b.k is not null then 'BOTH'
  when a.k is not null then 'ORDERS' else 'EVENTS' end as cohort_type
from (select distinct o_custkey as k from orders where o_orderstatus = 'P') a
full join (select distinct user_id as k from events where event_type = 'error') b on a.k = b.k""")
def q_label_cohort(s, spark):
    orders = s.src.table("orders").where("o_orderstatus = 'P'")
    errors = s.src.table("events").where("event_type = 'error'")
    return O.label_cohort(
        orders.select(F.col("o_custkey").alias("k")).distinct(),
        errors.select(F.col("user_id").alias("k")).distinct(),
        "k",
        ("BOTH", "ORDERS", "EVENTS"),
    )


@query("""
select * from lineitem where l_partkey not in (select p_partkey from part where p_type = 'PROMO')""")
def q_exclude(s, spark):
    promo = s.src.table("part").where("p_type = 'PROMO'")
    ids = promo.select(F.col("p_partkey").alias("l_partkey"))
    lines = s.src.table("lineitem")
    return O.exclude(lines, ids, "l_partkey").select(lines.columns)


@query("""
select c_custkey, c_nationkey, coalesce(r_name, 'elsewhere') as place
from customer left join region on c_nationkey = r_regionkey""")
def q_decode(s, spark):
    people = s.src.table("customer").select("c_custkey", "c_nationkey")
    return O.decode(
        people, s.src.table("region"), "c_nationkey", "r_regionkey", "place", "r_name", "elsewhere"
    )


@query("""
select dx_id, code as icd_code, 9 as icd_type from edg_current_icd9
union all select dx_id, code, 10 from edg_current_icd10""")
def q_code_map(s, spark):
    return O.code_map(s.src("edg_current_icd9"), s.src("edg_current_icd10"))


@query("""
with old as (select distinct c_custkey as k from customer where c_mktsegment = 'BUILDING'),
kept as (select k, row_number() over (order by sha256('s' || cast(k as varchar)), k) as id from old),
fresh as (select distinct c_custkey as k from customer where c_custkey not in (select k from old))
select k, id from kept
union all
select k, (select max(id) from kept)
  + row_number() over (order by sha256('s' || cast(k as varchar)), k) as id from fresh""")
def q_dense_key(s, spark):
    people = s.src.table("customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    kept = O.dense_key(people.where("c_mktsegment = 'BUILDING'"), "k", "id", "s")
    return O.dense_key(people, "k", "id", "s", existing=kept)


_TARGET = """(select distinct o_custkey as k, year(o_orderdate) as y, 'orders' as seen, cast(null as varchar) as late
  from orders)"""
_SOURCE = """(select distinct o_custkey as k, year(l_shipdate) as y from lineitem join orders on l_orderkey = o_orderkey
  where l_returnflag = 'R')"""


def _upsert_sides(s):
    orders = s.src.table("orders")
    target = orders.select(F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"))
    target = target.distinct().select(
        "k", "y", F.lit("orders").alias("seen"), F.lit(None).cast("string").alias("late")
    )
    returned = s.src.table("lineitem").where("l_returnflag = 'R'")
    source = returned.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("k"), F.year("l_shipdate").alias("y")
    )
    return target, source


@query(f"""
select k, cast(y as integer) as y, seen, late from (
  select t.k, t.y, t.seen, case when s.k is not null then 'Y' else t.late end as late
  from {_TARGET} t left join {_SOURCE} s on t.k = s.k and t.y = s.y
  union all
  select s.k, s.y, 'returns', 'N' from {_SOURCE} s
  where not exists (select 1 from {_TARGET} t where t.k = s.k and t.y = s.y))""")
def q_upsert(s, spark):
    target, source = _upsert_sides(s)
    added = {"seen": F.lit("returns"), "late": F.lit("N")}
    return O.upsert(target, source, ["k", "y"], {"late": F.lit("Y")}, added)


@query("""
select pat_id, pat_enc_csn_id, contact_date, icd_code, icd_type,
  case when o.k is null then 'inserted' when n.k is null then 'deleted' else 'updated' end as change,
  case when o.k and n.k then array_to_string(list_filter([
    if(o.primary_sec_flag is distinct from n.primary_sec_flag, 'primary_sec_flag', ''),
    if(o.admit_dx_flag is distinct from n.admit_dx_flag, 'admit_dx_flag', ''),
    if(o.poa_flag is distinct from n.poa_flag, 'poa_flag', ''),
    if(o.hsp_final_dx_flag is distinct from n.hsp_final_dx_flag, 'hsp_final_dx_flag', '')], lambda c: c <> ''), ',') end as columns
from (select *, true as k from st_dx_upsert_admit) o
full join (select *, true as k from st_diagnosis_fact where admit_dx_flag is null or poa_flag is null) n
  using (pat_id, pat_enc_csn_id, contact_date, icd_code, icd_type)
where columns is null or columns <> ''""")
def q_release_changes(s, spark):
    """What the later load steps and a narrower rule change in the diagnosis table."""
    keys = ["pat_id", "pat_enc_csn_id", "contact_date", "icd_code", "icd_type"]
    later = s("diagnosis_fact").where("admit_dx_flag is null or poa_flag is null")
    later = later.repartition(*keys[:4])  # as the load steps deal their rows out: these are not shuffled again
    changes = O.table_changes(s("dx_upsert_admit"), later, keys)
    return changes.withColumn("columns", F.array_join("columns", ","))


LAYOUT = (
    O.Field("order_proc_id", "long", required=True),
    O.Field("ord_value", "int", required=True, longest=8),
    O.Field("reference_unit", required=True, longest=5),
)


@query("""
select order_proc_id, ord_value, reference_unit, array_to_string(list_filter([
    if(order_proc_id is null, 'order_proc_id is missing', ''), if(ord_value is null, 'ord_value is missing', ''),
    if(not regexp_full_match(trim(ord_value), '[+-]?[0-9]{1,9}'), 'ord_value is not int', ''),
    if(length(ord_value) > 8, 'ord_value is longer than 8', ''),
    if(reference_unit is null, 'reference_unit is missing', ''),
    if(length(reference_unit) > 5, 'reference_unit is longer than 5', '')], lambda r: r <> ''), ', ') as reasons, count(*) as n
from (select * replace (nullif(ord_value, '') as ord_value, nullif(reference_unit, '') as reference_unit) from order_results)
group by all having reasons <> ''""")
def q_rejects(s, spark):
    """Results that do not fit a declared layout, with the reasons; the rest would be accepted."""
    rows = O.judged(s.src("order_results").select(*(f.name for f in LAYOUT)), LAYOUT)
    bad = O.rejected(rows).withColumn("reasons", F.array_join("reasons", ", "))
    return bad.groupBy("order_proc_id", "ord_value", "reference_unit", "reasons").agg(F.count("*").alias("n"))


@query(f"""
select t.k, cast(t.y as integer) as y, t.seen, case when exists (
  select 1 from {_SOURCE} s where s.k = t.k and s.y = t.y) then 'Y' else t.late end as late
from {_TARGET} t""")
def q_flag_exists(s, spark):
    target, source = _upsert_sides(s)
    return O.flag_exists(target, source, ["k", "y"], "late", F.lit("Y"))


@query("""
select l_suppkey, bool_or(l_returnflag = 'R') as returned, bool_or(l_tax > 0.07) as taxed
from lineitem group by l_suppkey""")
def q_merge_flags(s, spark):
    marks = {"returned": F.col("l_returnflag") == "R", "taxed": F.col("l_tax") > 0.07}
    return O.merge_flags(s.src.table("lineitem"), ["l_suppkey"], marks)


@query("select p_brand, p_type, count(*) as total from part group by all")
def q_review_list(s, spark):
    return O.review_list(s.src.table("part"), ["p_brand", "p_type"])


@query("""
select * from lineitem where (l_orderkey, l_suppkey) in (
  select l_orderkey, l_suppkey from lineitem where l_linenumber = 7)""")
def q_apply_selection(s, spark):
    lines = s.src.table("lineitem")
    chosen = lines.where("l_linenumber = 7")
    return O.apply_selection(lines, chosen, ["l_orderkey", "l_suppkey"]).select(lines.columns)


@query("""
select 1 as tag, doc_id as id, text from documents union select 2, conv_id, text from conversations""")
def q_tagged_union(s, spark):
    documents = s.src.table("documents").select(F.col("doc_id").alias("id"), "text")
    turns = s.src.table("conversations").select(F.col("conv_id").alias("id"), "text")
    return O.tagged_union([(1, documents), (2, turns)], "tag")


@query("""
select l_suppkey, 'FLAG' as demo_type, l_returnflag as demo_sub_type, count(distinct l_orderkey) as pat_count
from lineitem group by all
union all
select l_suppkey, 'STATUS', l_linestatus, count(distinct l_orderkey) from lineitem group by all""")
def q_profile(s, spark):
    dims = {"FLAG": "l_returnflag", "STATUS": "l_linestatus"}
    return O.profile(s.src.table("lineitem"), "l_suppkey", dims, "l_orderkey")


@query("""
with n as (select l_suppkey, l_quantity, count(*) as n from lineitem group by all)
select l_suppkey, round(avg(l_quantity), 6) as avg_value, quantile_cont(l_quantity, 0.5) as median_value,
  (select l_quantity from n where n.l_suppkey = l.l_suppkey order by n desc, l_quantity limit 1) as mode_value
from lineitem l group by l_suppkey""")
def q_panel_stats(s, spark):
    stats = O.panel_stats(s.src.table("lineitem"), "l_suppkey", "l_quantity")
    return stats.withColumn("avg_value", F.round("avg_value", 6))


@query("""
select l_partkey, l_suppkey, greatest(count(*), 10) as n from lineitem group by l_partkey, l_suppkey""")
def q_mask_small(s, spark):
    counted = O.review_list(s.src.table("lineitem"), ["l_partkey", "l_suppkey"], "n")
    return O.mask_small(counted, "n")


@query("""
select p.study_id, l.encounter_num, a.appt_serial_num from v_sched_appt a
join (select distinct pat_id, study_id from st_patient_table) p on a.pat_id = p.pat_id
left join bip_encounter_link l on a.pat_enc_csn_id = l.encounter_ide""")
def q_deidentify(s, spark):
    df = O.deidentify(s.src("v_sched_appt"), s("patient_table"), s.src("bip_encounter_link"))
    return O.check_private(df.select("study_id", "encounter_num", "appt_serial_num"))


@query("""
select 'orders' as table_name, count(distinct o_custkey) as pat_count, count(*) as total_count,
  'all orders' as description from orders
union all
select 'part', null, count(*), 'all parts' from part""")
def q_count_stage(s, spark):
    orders = O.count_stage(s.src.table("orders"), "orders", "all orders", "o_custkey")
    return orders.unionByName(O.count_stage(s.src.table("part"), "part", "all parts", None))
