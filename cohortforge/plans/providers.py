"""Provider dimension."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.operators import dense_key
from cohortforge.study import Study, stage


def provider_ids(s: Study) -> DataFrame:
    """Providers of encounters, procedures, panels, care list and problems."""
    lists = (
        ("encounters", "visit_prov_id"),
        ("procedure_fact", "proc_perf_prov_id"),
        ("patient_table", "cur_pcp_prov_id"),
        ("care_providers", "provider_id"),
        ("problem_list", "prov_id"),
    )
    named = [s(name).select(F.col(column).alias("provider_id")).distinct() for name, column in lists]
    return reduce(DataFrame.union, named).where("provider_id is not null").distinct()


@stage("Pseudonymous provider ids")
def provider_key(s: Study) -> DataFrame:
    earlier = s.keys.get("prov_study_id")
    return dense_key(provider_ids(s), "provider_id", "prov_study_id", s.cfg.salt, earlier)


@stage("Providers", stored=True)
def providers(s: Study) -> DataFrame:
    """The study's providers, described.

    A missing provider is left out, and a provider whose employee records differ
    has a row for each under one study id.
    """
    ids = provider_ids(s)
    described = s.src("v_cube_d_provider").select(
        "provider_id", "provider_type", "primary_specialty", "provider_name"
    )
    care = s("care_providers").select("provider_id").distinct().withColumn("_care", F.lit(True))
    staff = s.src("clarity_ser").select(F.col("prov_id").alias("provider_id"), "active_status")
    employees = s.src("clarity_emp").select(
        F.col("prov_id").alias("provider_id"), "user_status_c", "user_id"
    )
    active = (F.col("active_status") == "Active") & (F.col("user_status_c") == 1)
    rows = (
        ids.join(described, "provider_id", "left")
        .join(care, "provider_id", "left")
        .join(staff, "provider_id", "left")
        .join(employees, "provider_id", "left")
        .select(
            "provider_id",
            "provider_type",
            "primary_specialty",
            "provider_name",
            F.when(active, 1).alias("active_providers"),
            F.when(F.col("user_id").isNotNull(), 1).alias("uc_provider"),
            F.when(F.col("_care"), 1).otherwise(0).alias("hiv_provider"),
        )
        .distinct()
    )
    return s("provider_key").join(rows, "provider_id").select("prov_study_id", *rows.columns)
