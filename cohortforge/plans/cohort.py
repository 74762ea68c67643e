"""Case finding from diagnoses and laboratory results."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.config import Rule
from cohortforge.functions import (
    decode_value,
    harmonize_numeric,
    harmonize_qualitative,
    trimmed,
    windowed,
)
from cohortforge.operators import (
    exclude,
    first_event,
    label_cohort,
    rule_counts,
    rule_events,
)
from cohortforge.study import Study, stage

BOTH, ONLY_DX, LAB_ONLY = "DX + LAB", "ONLY DX", "LAB ONLY"

RESULT_COLUMNS = (
    "reference_unit",
    "ref_normal_vals",
    "reference_low",
    "reference_high",
    "order_status_c",
    "order_type_c",
    "result_flag_c",
    "specimn_taken_time",
)


@stage("First flagged diagnosis per patient", stored=True)
def first_dx_date(s: Study) -> DataFrame:
    flagged = s("dx_driver_map").where(F.col("dx_flag") == s.cfg.dx_flag).select("dx_id")
    dx = s.src("pat_enc_dx").transform(windowed, "contact_date", s.cfg)
    dx = dx.join(flagged.distinct(), "dx_id", "left_semi")
    return first_event(dx, "pat_id", "contact_date", out="first_hiv_date")


@stage("Components of the listed laboratory codes", stored=True)
def coded_components(s: Study) -> DataFrame:
    """Stored, so that their size is known where the results meet them."""
    codes = s.src("lnc_db_main").select(F.col("record_id").alias("default_lnc_id"), "lnc_code")
    return (
        s.src("clarity_component")
        .join(codes, "default_lnc_id", "left")
        .withColumn("loinc", F.coalesce("lnc_code", "loinc_code"))
        .join(s("lab_rule_driver"), "loinc")
        .select("component_id", F.col("name").alias("component_name"), "common_name", "step")
    )


@stage("Results of the listed laboratory codes", stored=True)
def coded_lab_pull(s: Study) -> DataFrame:
    """Results meet their orders first: few are left for the other joins.

    A whitespace-only result is no text.
    """
    cfg = s.cfg
    orders = (
        s.src("order_proc")
        .where(F.col("order_type_c").isin(*cfg.cohort_lab_types))
        .transform(windowed, "order_time", cfg)
        .select(
            "order_proc_id",
            "pat_id",
            "proc_id",
            "proc_code",
            "description",
            "order_time",
            "result_time",
            "order_status_c",
            "order_type_c",
        )
    )
    results = s.src("order_results").where("ord_value is not null").drop("pat_id", "result_time")
    specimens = s.src("order_proc_2").select("order_proc_id", "specimn_taken_time")
    pulled = (
        results.join(orders, "order_proc_id")
        .join(specimens, "order_proc_id")
        .join(s("coded_components"), "component_id")
        .join(s.src("patient").select("pat_id"), "pat_id", "left_semi")
    )
    harm = harmonize_numeric(F.col("ord_value"), F.col("ord_num_value"), cfg.strict_decimals)
    return pulled.select(
        "pat_id",
        "pat_enc_csn_id",
        "order_proc_id",
        "proc_id",
        "proc_code",
        "description",
        "component_id",
        "component_name",
        "order_time",
        "result_time",
        "result_date",
        trimmed(F.col("ord_value")).alias("ord_value"),
        "ord_num_value",
        *RESULT_COLUMNS,
        "step",
        harm.sign.alias("harm_sign"),
        harm.text.alias("harm_text_val"),
        harm.number.alias("harm_num_val"),
        "common_name",
    ).distinct()


@stage("Results with the qualitative flag")
def flagged_labs(s: Study) -> DataFrame:
    return s("coded_lab_pull").withColumn("lab_flag", harmonize_qualitative(F.col("ord_value")))


def rule_predicates(rules: tuple[Rule, ...], sentinel: int) -> list[tuple[Column, Column]]:
    """(scope, predicate) per kind, so that each result column is worked out once."""

    def steps(kind: str) -> dict[str, object]:
        return {r.step: r.value for r in rules if r.kind == kind}

    number = F.col("harm_num_val")
    tests = {
        "flag": lambda limit: F.col("lab_flag") == 1,
        "above": lambda limit: (number > limit) & (number != sentinel),
        "text": lambda limit: F.col("ord_value") == limit,
    }
    step = F.col("step")
    return [
        (step.isin(*found), test(decode_value(step, found)))
        for kind, test in tests.items()
        if (found := steps(kind))
    ]


@stage("Results that meet a positive rule", stored=True)
def rule_positive_events(s: Study) -> DataFrame:
    rules = rule_predicates(s.cfg.rules, s.cfg.numeric_sentinel)
    return rule_events(s("flagged_labs"), rules, ["pat_id", "result_date"])


@stage("Events and patients per positive rule and combination of rules")
def rule_attribution(s: Study) -> DataFrame:
    """What each rule adds to the case finding, from the scan that applies them."""
    met = {}
    for rule in s.cfg.rules:
        [(scope, predicate)] = rule_predicates((rule,), s.cfg.numeric_sentinel)
        met[rule.step] = scope & F.coalesce(predicate, F.lit(False))
    return rule_counts(s("flagged_labs"), met, "pat_id", ["result_date"])


def first_positive(s: Study) -> DataFrame:
    return first_event(
        s("rule_positive_events"), "pat_id", "result_date", out="first_hiv_lab_date"
    )


def first_dx(s: Study) -> DataFrame:
    return s("first_dx_date").withColumnRenamed("first_hiv_date", "first_hiv_dx_date")


COHORT_COLUMNS = ("pat_id", "first_hiv_dx_date", "first_hiv_lab_date", "cohort_type")


@stage("Patients found by diagnosis")
def cohort_dx(s: Study) -> DataFrame:
    labs = first_positive(s).withColumn("_lab", F.lit(True))
    kind = F.when(F.col("_lab"), BOTH).otherwise(ONLY_DX)
    found = first_dx(s).join(labs, "pat_id", "left")
    return found.withColumn("cohort_type", kind).select(*COHORT_COLUMNS)


@stage("Patients found by laboratory result only")
def cohort_lab_only(s: Study) -> DataFrame:
    found = exclude(first_positive(s), s("first_dx_date"), "pat_id")
    return found.select("pat_id", F.lit(LAB_ONLY).alias("cohort_type"), "first_hiv_lab_date")


def cohort_types() -> dict[str, Column]:
    """All rows, and those of each cohort type."""
    kinds = {kind: (F.col("cohort_type") == kind).cast("long") for kind in (BOTH, ONLY_DX, LAB_ONLY)}
    return {"": F.lit(1), **kinds}


@stage("Patients found either way", stored=True, parts=cohort_types)
def all_found(s: Study) -> DataFrame:
    labels = (BOTH, ONLY_DX, LAB_ONLY)
    found = label_cohort(first_dx(s), first_positive(s), "pat_id", labels)
    return found.select(*COHORT_COLUMNS)


@stage("Patients per cohort type")
def cohort_counts(s: Study) -> DataFrame:
    return s("all_found").groupBy("cohort_type").agg(F.count("*").alias("total_count"))


@stage("Patients left after removing restricted ones", stored=True)
def cohort(s: Study) -> DataFrame:
    flags = s.src("patient_fyi_flags").where(
        F.col("pat_flag_type_c").isin(*s.cfg.restricted_flags)
    )
    tests = s.src("patient_3").where("is_test_pat_yn = 'Y'")
    restricted = flags.select(F.col("patient_id").alias("pat_id")).union(tests.select("pat_id"))
    return exclude(s("all_found"), restricted, "pat_id")
