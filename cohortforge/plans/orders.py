"""Completed imaging, microbiology and pathology orders, and their reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import has_text, windowed
from cohortforge.operators import among, decode, review_list, tagged_union
from cohortforge.study import Study, stage


@stage("Orders with results", stored=True)
def order_procedures(s: Study) -> DataFrame:
    cfg = s.cfg
    kinds = (*cfg.imaging_types, cfg.microbiology_type, cfg.pathology_type)
    wanted = F.col("order_type_c").isin(*kinds) | (
        F.col("radiology_status_c") == cfg.final_radiology
    )
    orders = (
        s.src("order_proc")
        .where(F.col("order_status_c") == cfg.completed_status)
        .where(wanted)
        .transform(among, s("cohort"), "pat_id")
    )
    # the procedures are a long list: orders meet it, not their results
    orders = decode(orders, s.src("clarity_eap"), "proc_id", "proc_id", "proc_name", "proc_name")
    results = (
        s.src("order_results")
        .transform(windowed, "result_time", cfg)
        .select(
            "order_proc_id",
            "line",
            "ord_value",
            "component_id",
            "component_comment",
            F.col("result_time").alias("res_result_time"),
            "result_val_start_ln",
            "result_val_end_ln",
            "result_cmt_start_ln",
            "result_cmt_end_ln",
            "lrr_based_organ_id",
        )
    )
    df = orders.join(results, "order_proc_id").join(
        s.src("order_rad_acc_num").select("order_proc_id", "acc_num"), "order_proc_id", "left"
    )
    for on, table, code, alias, value in (
        ("component_id", "clarity_component", "component_id", "component_name", "name"),
        ("order_type_c", "zc_order_type", "order_type_c", "order_type", "name"),
        ("specimen_type_c", "zc_specimen_type", "specimen_type_c", "specimen_type", "name"),
    ):
        df = decode(df, s.src(table), on, code, alias, value)
    return df.select(
        "pat_id",
        "pat_enc_csn_id",
        "order_proc_id",
        "proc_id",
        "description",
        "proc_name",
        "proc_code",
        "order_time",
        "result_time",
        "order_type_c",
        "order_type",
        "abnormal_yn",
        "order_status_c",
        "radiology_status_c",
        "specimen_source_c",
        "specimen_type_c",
        "acc_num",
        "specimen_type",
        "line",
        "ord_value",
        "component_id",
        "component_name",
        "component_comment",
        "res_result_time",
        "result_val_start_ln",
        "result_val_end_ln",
        "result_cmt_start_ln",
        "result_cmt_end_ln",
        "lrr_based_organ_id",
    ).distinct()


@stage("Orders for review")
def order_review_list(s: Study) -> DataFrame:
    return review_list(s("order_procedures"), ["description", "proc_name", "proc_code"], "n")


def comments(s: Study, order_type: int, prefix: str) -> DataFrame:
    """Component (1) and result (2) comments of one order type.

    A semi-join: an order's result rows must not be paired with its comment lines.
    """
    orders = s("order_procedures").where(F.col("order_type_c") == order_type)
    orders = orders.select(F.col("order_proc_id").alias("order_id"))
    parts = []
    for mark, table, line, text in (
        (1, "order_res_comp_cmt", "line_comp", "results_comp_cmt"),
        (2, "order_res_comment", "line", "results_cmt"),
    ):
        part = s.src(table).where(has_text(F.col(text))).transform(among, orders, "order_id")
        parts.append(
            (
                mark,
                part.select(
                    F.col("order_id").alias(f"{prefix}_order_id"),
                    F.col(line).alias(f"{prefix}_line"),
                    F.col(text).alias(f"{prefix}_results_cmt"),
                    F.col("line_comment").alias(f"{prefix}_line_comment"),
                ),
            )
        )
    return tagged_union(parts, f"{prefix}_sorting")


@stage("Microbiology comments", stored=True, by="micro_order_id")
def micro_comments(s: Study) -> DataFrame:
    return comments(s, s.cfg.microbiology_type, "micro")


@stage("Pathology comments", stored=True, by="path_order_id")
def path_comments(s: Study) -> DataFrame:
    return comments(s, s.cfg.pathology_type, "path")


@stage("Microbiology susceptibility", stored=True, by="order_proc_id")
def micro_susceptibility(s: Study) -> DataFrame:
    orders = s("micro_comments").select(F.col("micro_order_id").alias("order_proc_id"))
    df = s.src("order_sensitivity").join(orders, "order_proc_id", "left_semi")
    for on, table, code, alias in (
        ("organism_id", "clarity_organism", "organism_id", "organism_name"),
        ("suscept_c", "zc_suscept", "suscept_c", "susceptibility"),
        ("antibiotic_c", "zc_antibiotic", "antibiotic_c", "antibiotic"),
    ):
        df = decode(df, s.src(table), on, code, alias)
    return df.select(
        "order_proc_id",
        "organism_name",
        "susceptibility",
        F.col("sensitivity_value").alias("sensitivity"),
        "antibiotic",
        "line",
    ).distinct()


@stage("Imaging orders", stored=True)
def imaging_orders(s: Study) -> DataFrame:
    return s("order_procedures").where(F.col("radiology_status_c") == s.cfg.final_radiology)


def report_lines(s: Study, table: str, text: str, prefix: str) -> DataFrame:
    """Report lines of the imaging orders; texts of other orders are left out before a shuffle."""
    orders = s("imaging_orders").select("pat_id", "acc_num", "order_proc_id")
    lines = s.src(table).where(has_text(F.col(text))).transform(among, orders, "order_proc_id")
    orders = orders.distinct()
    return (
        lines.join(orders, "order_proc_id")
        .select(
            "pat_id",
            "acc_num",
            "order_proc_id",
            F.col("line").alias(f"{prefix}_line"),
            F.col(text).alias(f"{prefix}_{text}"),
        )
        .distinct()
    )


@stage("Imaging narratives", stored=True)
def imaging_narratives(s: Study) -> DataFrame:
    return report_lines(s, "order_narrative", "narrative", "narr")


@stage("Imaging impressions", stored=True)
def imaging_impressions(s: Study) -> DataFrame:
    return report_lines(s, "order_impression", "impression", "impr")
