"""Provider panel reports."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import concat_present, months_age
from cohortforge.operators import panel_stats, profile, suppress
from cohortforge.study import Study, stage

# Dimension label -> column.
PANEL_DIMENSIONS = {
    "ETHNIC_GROUP": "ethnic_group",
    "MAPPED_RACE_NAME": "mapped_race_name",
    "SEX": "sex",
    "MARITAL_STATUS": "marital_status",
    "GENDER_IDENT": "gender_ident",
    "SEXUAL_ORIENT": "sexual_orient",
    "INCOME_CLASSIFICATION": "income_cd",
    "EDUCATION_CLASSIFICATION": "education_cd",
}


def panel_ids(s: Study) -> DataFrame:
    """One row a provider, however many employee records there are."""
    ids = s("providers").select(F.col("provider_id").alias("cur_pcp_prov_id"), "prov_study_id")
    return ids.distinct()


def panel(s: Study) -> DataFrame:
    """Providers with the patients whose primary care provider they are."""
    return s.src("lz_clarity_patient").join(panel_ids(s), "cur_pcp_prov_id")


def panel_places(s: Study) -> DataFrame:
    places = s.src("bip_pat_geocode").select(
        "pat_id",
        "income_cd",
        "education_cd",
        "state_fips",
        "cnty_fips",
        "stcofips",
        "tract",
        "tract_fips",
        "fips",
    )
    return panel(s).join(places, "pat_id", "left")


@stage("Panel profile")
def panel_profile(s: Study) -> DataFrame:
    return profile(panel_places(s), "prov_study_id", PANEL_DIMENSIONS, "pat_id")


@stage("Panel profile for release")
def panel_profile_masked(s: Study) -> DataFrame:
    """The profile without small cells, nor what shows them beside a panel's total."""
    by = ["prov_study_id", "demo_type"]
    cells = suppress(s("panel_profile"), by, "demo_sub_type", "pat_count", s.cfg.mask_floor)
    return cells.drop("pat_count").withColumnRenamed("shown", "pat_count")


@stage("Panel ages")
def panel_age(s: Study) -> DataFrame:
    """Ages of the patients of each panel, and how many of them are in the patient table."""
    people = panel(s)
    heads = people.groupBy("prov_study_id").agg(F.count_distinct("pat_id").alias("total_patients"))
    age = months_age(F.col("birth_date"), s.cfg.as_of)
    ages = panel_stats(people.select("prov_study_id", age.alias("age")), "prov_study_id", "age")
    care = (
        s("patient_table")
        .select("cur_pcp_prov_id")
        .join(panel_ids(s), "cur_pcp_prov_id")
        .groupBy("prov_study_id")
        .agg(F.count("*").alias("hiv_patients"))
    )
    return (
        heads.join(ages, "prov_study_id")
        .join(care, "prov_study_id", "left")
        .select(
            "prov_study_id",
            "total_patients",
            F.col("avg_value").alias("avg_age"),
            F.col("median_value").alias("median_age"),
            F.col("mode_value").alias("mode_age"),
            "hiv_patients",
        )
    )


@stage("Panel places")
def panel_geocode(s: Study) -> DataFrame:
    """Grouped by the stored tract too, which is not shown: rows may look repeated."""
    tract = concat_present(F.col("stcofips"), F.col("tract"))
    return (
        panel_places(s)
        .groupBy(
            "prov_study_id",
            "state_fips",
            "cnty_fips",
            F.col("tract_fips").alias("_stored_tract"),
            tract.alias("tract_fips"),
            "fips",
        )
        .agg(F.count_distinct("pat_id").alias("pat_count"))
        .drop("_stored_tract")
    )
