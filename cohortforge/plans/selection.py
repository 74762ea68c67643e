"""Medications and labs: pull all, list for review, keep what was chosen."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import harmonize_numeric, resolve_medication, trimmed, windowed
from cohortforge.operators import among, among_dealt, apply_selection, decode, review_list
from cohortforge.plans.cohort import RESULT_COLUMNS
from cohortforge.study import Study, stage

DRUG_CLASSES = ("pharm_class", "thera_class", "pharm_subclass")


def with_drug_classes(s: Study, df: DataFrame) -> DataFrame:
    for name in DRUG_CLASSES:
        df = decode(df, s.src(f"zc_{name}"), f"{name}_c", f"{name}_c", name)
    return df


@stage("All medication orders", stored=True)
def all_medications(s: Study) -> DataFrame:
    cfg = s.cfg
    info = s.src("order_medinfo").select("order_med_id", "dispensable_med_id", "last_admin_inst")
    given = s.src("mar_admin_info").select(
        "order_med_id", "infusion_rate", "mar_inf_rate_unit_c", "taken_time", "route_c"
    )
    orders = (
        s.src("order_med")
        .where("ordering_date is not null or start_date is not null")
        .transform(windowed, "order_start_time", cfg)
        .transform(among, s("cohort"), "pat_id")
    )
    routes = s.src("zc_admin_route").select(
        F.col("med_route_c").alias("route_c"),
        F.col("name").alias("route_name"),
        F.col("abbr").alias("route_abbreviation"),
    )
    frequency = s.src("ip_frequency").select(F.col("freq_id").alias("hv_discr_freq_id"), "freq_name")
    used = resolve_medication(
        F.col("medication_id"),
        F.col("dispensable_med_id"),
        F.col("user_sel_med_id"),
        cfg.placeholder_medication,
    )
    drugs = s.src("clarity_medication").select(
        F.col("medication_id").alias("used_med_id"),
        "pharm_class_c",
        "thera_class_c",
        "pharm_subclass_c",
        F.col("name").alias("medication_name"),
        "generic_name",
    )
    # the short lists come last: their texts are not shuffled
    df = (
        orders.join(info, "order_med_id", "left")
        .join(given, "order_med_id", "left")
        .withColumn("used_med_id", used)
        .join(drugs, "used_med_id", "left")
        .join(routes, "route_c", "left")
        .join(frequency, "hv_discr_freq_id", "left")
    )
    for on, table, code, alias in (
        ("hv_dose_unit_c", "zc_med_unit", "disp_qtyunit_c", "dose_unit"),
        ("order_status_c", "zc_order_status", "order_status_c", "order_status"),
        ("ordering_mode_c", "zc_ordering_mode", "ordering_mode_c", "ordering_mode"),
        ("med_dis_disp_unit_c", "zc_med_unit", "disp_qtyunit_c", "dis_dose_unit"),
        ("mar_inf_rate_unit_c", "zc_med_unit", "disp_qtyunit_c", "inf_rate_dose_unit"),
        ("order_class_c", "zc_order_class", "order_class_c", "order_class"),
    ):
        df = decode(df, s.src(table), on, code, alias)
    return with_drug_classes(s, df).select(
        "pat_id",
        "pat_enc_csn_id",
        "order_med_id",
        "order_inst",
        "order_start_time",
        "order_end_time",
        "used_med_id",
        "medication_id",
        "hv_discrete_dose",
        "dose_unit",
        "med_dis_disp_qty",
        "dis_dose_unit",
        "order_status",
        "ordering_mode",
        "order_class",
        "last_admin_inst",
        "sig",
        "quantity",
        "freq_name",
        "refills",
        "route_name",
        "route_abbreviation",
        "infusion_rate",
        "mar_inf_rate_unit_c",
        "taken_time",
        "inf_rate_dose_unit",
        "pharm_class_c",
        "pharm_class",
        "thera_class_c",
        "thera_class",
        "pharm_subclass_c",
        "pharm_subclass",
        "medication_name",
        "generic_name",
    ).distinct()


@stage("Medications for review")
def med_review_list(s: Study) -> DataFrame:
    """Counted per drug before the lookups, so only the drugs meet them."""
    drug = ["medication_id", "medication_name", "generic_name"]
    counted = review_list(s("all_medications"), drug, "n")
    classes = s.src("clarity_medication").select(
        "medication_id", *(f"{name}_c" for name in DRUG_CLASSES)
    )
    df = with_drug_classes(s, counted.join(classes, "medication_id"))
    return df.groupBy(*drug, *DRUG_CLASSES).agg(F.sum("n").alias("total"))


@stage("Medications chosen", stored=True)
def select_medications(s: Study) -> DataFrame:
    return apply_selection(s("all_medications"), s("med_selection_driver"), ["medication_id"])


@stage("All lab results", stored=True)
def all_labs(s: Study) -> DataFrame:
    cfg = s.cfg
    orders = (
        s.src("order_proc")
        .where(F.col("order_type_c").isin(*cfg.lab_types))
        .transform(windowed, "ordering_date", cfg)
        .select(
            "order_proc_id",
            "proc_id",
            "proc_code",
            "description",
            "order_time",
            "result_time",
            "order_status_c",
            "order_type_c",
        )
    )
    results = s.src("order_results").where("ord_value is not null").drop("result_time")
    components = s.src("clarity_component").select(
        "component_id", F.col("name").alias("component_name"), "common_name"
    )
    specimens = s.src("order_proc_2").select("order_proc_id", "specimn_taken_time")
    # tables dealt out by order stay so to the end: only pairs of order and person are shuffled
    df = (
        results.join(orders, "order_proc_id")
        .join(specimens, "order_proc_id", "left")
        .transform(among_dealt, s("cohort"), "pat_id", "order_proc_id")
        .join(components, "component_id")
    )
    harm = harmonize_numeric(F.col("ord_value"), F.col("ord_num_value"), cfg.strict_decimals)
    return df.select(
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
        harm.sign.alias("harm_sign"),
        harm.text.alias("harm_text_val"),
        harm.number.alias("harm_num_val"),
        "common_name",
    ).distinct()


@stage("Labs for review")
def lab_review_list(s: Study) -> DataFrame:
    return review_list(
        s("all_labs"), ["proc_id", "description", "component_id", "component_name"]
    )


@stage("Labs chosen", stored=True)
def select_labs(s: Study) -> DataFrame:
    return apply_selection(s("all_labs"), s("lab_selection_driver"), ["proc_id", "component_id"])
