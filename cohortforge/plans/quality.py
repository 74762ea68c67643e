"""The count ledger over all stages."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.operators import (
    count_common,
    count_groups,
    count_sets,
    count_stage,
    labelled_sets,
    ledger,
)
from cohortforge.plans.diagnoses import STEPS, diagnosis_counts
from cohortforge.plans.procedures import PARTS, procedure_counts
from cohortforge.study import NOTES, NUMBERS, PERSON, Study, stage

# Counted as they are; diagnoses and procedures are counted step by step.
COUNTED = (
    "primary_care_depts",
    "dx_code_driver",
    "dx_driver_map",
    "care_providers",
    "lab_rule_driver",
    "first_dx_date",
    "coded_lab_pull",
    "rule_positive_events",
    "cohort",
    "patient_table",
    "patient_race",
    "patient_ethnicity",
    "patient_geocode",
    "all_medications",
    "select_medications",
    "all_labs",
    "lab_selection_driver",
    "select_labs",
    "encounters",
    "vitals",
    "latest_social_history",
    "problem_list",
    "problem_list_dx",
    "providers",
    "adt_events",
    "appointments",
    "latest_family_history",
    "order_procedures",
    "micro_comments",
    "micro_susceptibility",
    "path_comments",
    "imaging_orders",
    "imaging_narratives",
    "imaging_impressions",
    "encounter_key",
)

# stage -> (column to group by, column to count distinct, wording)
GROUPED = {
    "dx_code_driver": ("dx_flag", "icd_code", "Codes listed for "),
    "dx_driver_map": ("dx_flag", None, "Codes mapped for "),
    "lab_rule_driver": ("step", None, "Codes of step "),
    "all_found": ("cohort_type", None, "Patients where cohort type = "),
    "patient_table": ("cohort_type", None, "Patients where cohort type = "),
}


# Stages whose parts are load steps, each with a ledger row of its own.
BY_STEP = ("diagnosis_marks", "procedure_fact")

# Stages through which people stay in the study, each within the one before.
STAYING = ("all_found", "cohort", "patient_table", "encounters", "diagnosis_marks", "all_labs")

# Dimension label -> column of the patient table.
DIMENSIONS = {"SEX": "sex", "MARITAL_STATUS": "marital_status", "COHORT_TYPE": "cohort_type"}


def entries(s: Study, names: tuple[str, ...]) -> list[DataFrame]:
    return [count_stage(s(name), name, NOTES[name]) for name in names]


def grouped(s: Study, stages: dict[str, tuple]) -> list[DataFrame]:
    return [
        count_groups(s(name), name, words, by, distinct_on)
        for name, (by, distinct_on, words) in stages.items()
    ]


def from_rows(s: Study) -> list[DataFrame]:
    """Ledger rows counted from the stages."""
    return [*entries(s, COUNTED), diagnosis_counts(s), procedure_counts(s), *grouped(s, GROUPED)]


def from_writing(s: Study) -> list[DataFrame]:
    """The same from what was kept when the stages were written: row counts, and sets of people.

    No stage is read again, but for the driver lists, whose groups are not known beforehand.
    """
    spark = s("cohort").sparkSession
    layout = "table_name string, total_count long, description string"
    rows = spark.createDataFrame([(n, s.rows(n), NOTES[n]) for n in COUNTED], layout)
    with_people = [n for n in (*COUNTED, *GROUPED, *BY_STEP) if PERSON in s(n).columns]
    counts = count_sets(s.people(dict.fromkeys(with_people)), ["stage", "part"])

    whole = counts.where("part = ''").select(F.col("stage").alias("table_name"), "pat_count")
    entries_ = rows.join(whole, "table_name", "left")
    empty = F.col("table_name").isin(*with_people) & F.col("pat_count").isNull()
    entries_ = entries_.withColumn("pat_count", F.when(empty, 0).otherwise(F.col("pat_count")))

    steps = spark.createDataFrame([(n, NOTES[n]) for n in (*STEPS, *PARTS)], "part string, description string")
    of_steps = counts.where(F.col("stage").isin(*BY_STEP))
    stepped = steps.join(of_steps, "part", "left").select(
        F.col("part").alias("table_name"),
        *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("pat_count", "total_count")),
        "description",
    )

    by_people = {n: words for n, (_, _, words) in GROUPED.items() if n in with_people}
    wording = F.element_at(F.create_map(*(F.lit(x) for pair in by_people.items() for x in pair)), F.col("stage"))
    kinds = counts.where(F.col("stage").isin(*by_people)).where("part <> ''").select(
        F.col("stage").alias("table_name"),
        F.lit(None).cast("long").alias("pat_count"),
        "total_count",
        F.concat(wording, F.col("part")).alias("description"),
    )
    lists = {n: how for n, how in GROUPED.items() if n not in with_people}
    return [entries_, stepped, kinds, *grouped(s, lists)]


@stage("Count ledger", stored=True)
def qa_ledger(s: Study) -> DataFrame:
    parts = from_rows(s) if s.store is None else from_writing(s)
    columns = ("table_name", "pat_count", "total_count", "description")
    return ledger([part.select(*columns) for part in parts])


@stage("Count ledger extract")
def extract_counts(s: Study) -> DataFrame:
    return s("qa_ledger")


def whole_sets(s: Study, names: tuple[str, ...]) -> DataFrame:
    """One set a stage: all its people."""
    last = list(STEPS)[-1]  # after the last step all rows are there
    whole = F.when(F.col("stage") == "diagnosis_marks", last).otherwise("")
    return s.people(names).where(F.col("part") == whole)


@stage("People who stay in the study, stage by stage")
def attrition(s: Study) -> DataFrame:
    """Per stage its people, those in all stages up to it, and those lost there; from the sets."""
    spark = s("cohort").sparkSession
    sets = whole_sets(s, STAYING)
    upto = [(k, name) for k in range(1, len(STAYING) + 1) for name in STAYING[:k]]
    within = spark.createDataFrame(upto, "step int, stage string")
    stages = spark.createDataFrame([(k, n) for k, n in enumerate(STAYING, 1)], "step int, stage string")
    own = count_sets(sets, ["stage"]).select("stage", F.col("pat_count").alias("people"))
    counted = None
    for k in range(1, len(STAYING) + 1):
        through = within.where(F.col("step") == k).join(sets, "stage")
        staying = count_common(through, ["step"], "stage", k)
        counted = staying if counted is None else counted.unionByName(staying)
    kept = stages.join(own, "stage", "left").join(counted, "step", "left").select(
        "step",
        "stage",
        F.coalesce("people", F.lit(0)).alias("people"),
        F.coalesce("pat_count", F.lit(0)).alias("kept"),
    )
    before = kept.select((F.col("step") + 1).alias("step"), F.col("kept").alias("_before"))
    lost = F.coalesce(F.col("_before") - F.col("kept"), F.lit(0)).alias("lost")
    return kept.join(before, "step", "left").select("step", "stage", "people", "kept", lost)


@stage("People of each stage by demographic group")
def stage_profile(s: Study) -> DataFrame:
    """Per stage and value of a dimension, the patients of the patient table that the stage has.

    The values' sets are made once from the patient table; the stages' own are not read again.
    """
    people = s("patient_table")
    named = [F.col(column).cast("string").alias(label) for label, column in DIMENSIONS.items()]
    long = people.select("pat_id", *named).unpivot(["pat_id"], list(DIMENSIONS), "demo_type", "demo_sub_type")
    value = F.to_json(F.struct("demo_type", "demo_sub_type")).alias("part")
    values = labelled_sets(
        long.select(F.col("pat_id").alias("_key"), value, F.lit(1).alias("total")).distinct(), s(NUMBERS)
    )
    stages = whole_sets(s, STAYING[2:])
    # two sets meet where they have the same bitmap, or the same person without a number
    meets = (F.col("v.bucket").eqNullSafe(F.col("s.bucket"))) & (F.col("v.loose").eqNullSafe(F.col("s.loose")))
    sides = F.array(*(F.struct(F.lit(side).alias("side"), F.col(f"{side}.people").alias("people")) for side in "vs"))
    both = values.alias("v").join(stages.alias("s"), meets).select(
        "s.stage", "v.part", "v.bucket", "v.loose", F.inline(sides)
    )
    counted = count_common(both, ["stage", "part"], "side", 2)
    parsed = F.from_json("part", "demo_type string, demo_sub_type string").alias("g")
    return counted.select("stage", parsed, "pat_count").select("stage", "g.*", "pat_count")
