"""The diagnosis fact: step by step, and in one pass."""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import day_of, in_window, join_landed, windowed
from cohortforge.operators import (
    Field,
    among,
    code_map,
    count_steps,
    decode,
    enforced,
    flag_exists,
    merge_flags,
    upsert,
)
from cohortforge.study import NOTES, Study, stage

FOUR_KEYS = ["pat_id", "pat_enc_csn_id", "contact_date", "icd_code"]
FIVE_KEYS = [*FOUR_KEYS, "icd_type"]
FLAGS = ["primary_sec_flag", "admit_dx_flag", "poa_flag", "hsp_final_dx_flag"]
CODE_TYPES = (9, 10)


def coded(s: Study, df: DataFrame) -> DataFrame:
    """Attach the codes of both editions; interface-terminology codes are left out."""
    codes = code_map(s.src("edg_current_icd9"), s.src("edg_current_icd10"))
    codes = codes.where(~F.col("icd_code").startswith(s.cfg.excluded_code_prefix)).distinct()
    return df.join(codes, "dx_id")


UNCODED = ("pat_id", "pat_enc_csn_id", "contact_date", "dx_id", "source", "present", "adult")


def encounter_dx(s: Study) -> DataFrame:
    """Encounter diagnoses, with whether the patient is in the patient table."""
    adult = s("patient_table").select("pat_id").distinct().withColumn("_adult", F.lit(True))
    people = s("cohort").select("pat_id").join(adult, "pat_id", "left")
    source = F.when(F.col("primary_dx_yn") == "Y", "primary").otherwise("secondary")
    return (
        s.src("pat_enc_dx")
        .transform(windowed, "contact_date", s.cfg)
        .join(people, "pat_id")
        .withColumns(
            {
                "source": source,
                "present": F.lit(False),
                "adult": F.coalesce("_adult", F.lit(False)),
            }
        )
        .select(*UNCODED)
    )


def admit_dx(s: Study) -> DataFrame:
    days = s.src("date_dimension")
    days = days.select(F.col("epic_dte").alias("pat_enc_date_real"), day_of(days, "calendar_dt").alias("contact_date"))
    # only the window's days, so that a table landed in slices of days is pruned by them
    days = days.where(in_window(F.col("contact_date"), s.cfg))
    dx = s.src("hsp_admit_diag").where("pat_enc_date_real is not null and dx_id is not null")
    dx = join_landed(dx, days, "pat_enc_date_real")
    marks = {"source": F.lit("admit"), "present": F.lit(False), "adult": F.lit(True)}
    return dx.transform(among, s("cohort"), "pat_id").withColumns(marks).select(*UNCODED)


def account_dx(s: Study) -> DataFrame:
    """Final diagnoses of the hospital accounts of adult patients' stays."""
    visits = s("encounters").where("hosp_admsn_time is not null")
    visits = visits.withColumn("contact_date", day_of(visits, "hosp_admsn_time"))
    visits = (
        visits.where(in_window(F.col("contact_date"), s.cfg))
        .select("pat_id", "pat_enc_csn_id", "contact_date", "hsp_account_id")
        .join(s("patient_table").select("pat_id"), "pat_id", "left_semi")
    )
    lines = s.src("hsp_acct_dx_list").where("line >= 1")
    lines = decode(lines, s.src("zc_dx_poa"), "final_dx_poa_c", "dx_poa_c", "poa_name")
    marks = {
        "source": F.when(F.col("line") == 1, "final_first").otherwise("final_rest"),
        "present": (F.col("line") > 1) & F.col("poa_name").eqNullSafe("Yes"),
        "adult": F.lit(True),
    }
    return visits.join(lines, "hsp_account_id").withColumns(marks).select(*UNCODED)


def coded_dx(s: Study, *parts: DataFrame) -> DataFrame:
    """Diagnoses of the parts with their codes; only a primary ICD-9 row may be a minor's."""
    primary9 = (F.col("source") == "primary") & (F.col("icd_type") == 9)
    rows = coded(s, reduce(DataFrame.unionByName, parts))
    return rows.where(F.col("adult") | primary9).select(*FIVE_KEYS, "source", "present")


def dealt(df: DataFrame) -> DataFrame:
    """Keys dealt out by those that all load steps share, so that no step shuffles the table again."""
    return df.select(*FIVE_KEYS).repartition(*FOUR_KEYS).distinct()


def from_source(df: DataFrame, source: str) -> DataFrame:
    return dealt(df.where(F.col("source") == source))


@stage("Diagnoses initial load")
def dx_primary(s: Study) -> DataFrame:
    empty = [F.lit(None).cast("string").alias(name) for name in FLAGS[1:]]
    return from_source(coded_dx(s, encounter_dx(s)), "primary").select(
        *FIVE_KEYS, F.lit("P").alias(FLAGS[0]), *empty
    )


@stage("Load secondary dx if they do not already exist")
def dx_add_secondary(s: Study) -> DataFrame:
    """The key leaves out the code type: a primary row of either edition wins."""
    return upsert(
        s("dx_primary"),
        from_source(coded_dx(s, encounter_dx(s)), "secondary"),
        FOUR_KEYS,
        on_insert={"primary_sec_flag": F.lit("S")},
    )


@stage("Load admit dx")
def dx_upsert_admit(s: Study) -> DataFrame:
    admit = {"admit_dx_flag": F.lit("A")}
    source = from_source(coded_dx(s, admit_dx(s)), "admit")
    return upsert(s("dx_add_secondary"), source, FIVE_KEYS, admit, admit)


@stage("Load final account dx, line 1")
def dx_upsert_final_primary(s: Study) -> DataFrame:
    final = {"hsp_final_dx_flag": F.lit("1"), "primary_sec_flag": F.lit("P")}
    source = from_source(coded_dx(s, account_dx(s)), "final_first")
    return upsert(s("dx_upsert_admit"), source, FIVE_KEYS, final, final)


@stage("Load final account dx, line 2 to end")
def dx_upsert_final_secondary(s: Study) -> DataFrame:
    final = {"hsp_final_dx_flag": F.lit("1")}
    source = from_source(coded_dx(s, account_dx(s)), "final_rest")
    added = {**final, "primary_sec_flag": F.lit("S")}
    return upsert(s("dx_upsert_final_primary"), source, FIVE_KEYS, final, added)


@stage("Update the present-on-admission flag")
def dx_flag_poa(s: Study) -> DataFrame:
    present = dealt(coded_dx(s, account_dx(s)).where("present"))
    target = s("dx_upsert_final_secondary")
    return flag_exists(target, present, FIVE_KEYS, "poa_flag", F.lit("Y"))


# The declared layout of the fact.
LAYOUT = (
    Field("pat_id", longest=18),
    Field("pat_enc_csn_id", required=True),
    Field("contact_date"),
    Field("icd_code", longest=254),
    Field("icd_type"),
    Field("primary_sec_flag", longest=1),
    Field("admit_dx_flag", longest=1),
    Field("poa_flag", longest=50),
    Field("hsp_final_dx_flag", longest=1),
)

# step -> the sources that have added rows by then
STEPS = {
    "dx_primary": ("primary",),
    "dx_add_secondary": ("primary", "secondary"),
    "dx_upsert_admit": ("primary", "secondary", "admit"),
    "dx_upsert_final_primary": ("primary", "secondary", "admit", "final_first"),
    "dx_upsert_final_secondary": ("primary", "secondary", "admit", "final_first", "final_rest"),
    "dx_flag_poa": ("primary", "secondary", "admit", "final_first", "final_rest"),
}


def rows_after(step: str, kind: int) -> Column:
    """Whether a key has a row of an edition after a step."""
    return reduce(or_, (F.col(f"{source}_{kind}") for source in STEPS[step]))


def rows_by_step() -> dict[str, Column]:
    """The rows that a key has after each step."""
    return {
        step: sum((rows_after(step, kind).cast("long") for kind in CODE_TYPES), F.lit(0))
        for step in STEPS
    }


@stage("Marks of all diagnosis sources by key", stored=True, parts=rows_by_step)
def diagnosis_marks(s: Study) -> DataFrame:
    """Which sources name a code, by the four keys: one join to the codes, one shuffle.

    Both editions of a key sit in one row, as a primary row of either keeps a secondary one out.
    """
    rows = coded_dx(s, encounter_dx(s), admit_dx(s), account_dx(s))
    marks = {}
    for kind in CODE_TYPES:
        of_kind = F.col("icd_type") == kind
        for source in ("primary", "secondary", "admit", "final_first", "final_rest"):
            marks[f"{source}_{kind}"] = of_kind & (F.col("source") == source)
        marks[f"present_{kind}"] = of_kind & F.col("present")
    merged = merge_flags(rows, FOUR_KEYS, marks)
    any_primary = F.col("primary_9") | F.col("primary_10")
    added = {f"secondary_{k}": F.col(f"secondary_{k}") & ~any_primary for k in CODE_TYPES}
    return merged.withColumns(added)


def diagnosis_counts(s: Study) -> DataFrame:
    """Ledger rows of the six steps, without taking them."""
    counted = s("diagnosis_marks").withColumns(rows_by_step())
    return count_steps(counted, {step: (step, NOTES[step]) for step in STEPS})


@stage("Diagnoses")
def diagnosis_fact(s: Study) -> DataFrame:
    """All six steps at once: each edition of a key with a mark becomes a row.

    A row that breaks the declared layout stops the job.
    """

    def edition(kind: int):
        def has(source: str):
            return F.col(f"{source}_{kind}")

        final = has("final_first") | has("final_rest")
        rank = (
            F.when(has("final_first") | has("primary"), "P")
            .when(has("secondary"), "S")
            .when(has("admit"), F.lit(None))
            .otherwise("S")
        )
        return F.struct(
            F.lit(kind).alias("icd_type"),
            rank.alias("primary_sec_flag"),
            F.when(has("admit"), "A").alias("admit_dx_flag"),
            F.when(has("present"), "Y").alias("poa_flag"),
            F.when(final, "1").alias("hsp_final_dx_flag"),
            rows_after("dx_flag_poa", kind).alias("exists"),
        )

    editions = F.explode(F.array(*(edition(kind) for kind in CODE_TYPES))).alias("e")
    rows = s("diagnosis_marks").select(*FOUR_KEYS, editions).where("e.exists")
    rows = rows.select(*FOUR_KEYS, "e.icd_type", *(f"e.{name}" for name in FLAGS))
    return enforced(rows, LAYOUT).select(rows.columns)
