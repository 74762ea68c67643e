"""Patient table and patient attributes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import age_years, incomplete_address
from cohortforge.operators import among, decode, dense_key
from cohortforge.plans.cohort import cohort_types
from cohortforge.study import Study, stage


def adults(s: Study) -> DataFrame:
    """Cohort patients of age at `as_of`; unknown birth dates are dropped."""
    people = s.src("patient").where(
        age_years(F.col("birth_date"), s.cfg.as_of) >= s.cfg.adult_age
    )
    return s("cohort").join(people, "pat_id")


@stage("Adult cohort patients")
def adult_filter(s: Study) -> DataFrame:
    age = age_years(F.col("birth_date"), s.cfg.as_of)
    return adults(s).select("pat_id", "birth_date", age.alias("age"))


@stage("Pseudonymous study ids", stored=True)
def study_id_map(s: Study) -> DataFrame:
    return dense_key(adults(s), "pat_id", "study_id", s.cfg.salt, s.keys.get("study_id"))


@stage("Numbers of people, for their sets", stored=True)
def person_number(s: Study) -> DataFrame:
    """A dense number for everyone in the patient table, kept from release to release."""
    people = s.src("patient")
    return dense_key(people, "pat_id", "number", s.cfg.salt, s.keys.get("number")).select("pat_id", "number")


@stage("Adult cohort patients with decoded demographics", stored=True, parts=cohort_types)
def patient_table(s: Study) -> DataFrame:
    orientation = s.src("pat_sexual_orientation").select("pat_id", "sexual_orientatn_c")
    gender = s.src("patient_4").select("pat_id", "gender_identity_c")
    df = (
        adults(s)
        .join(orientation, "pat_id", "left")
        .join(gender, "pat_id", "left")
        .join(s("study_id_map"), "pat_id")
    )
    for on, table, code, alias in (
        ("marital_status_c", "zc_marital_status", "marital_status_c", "marital_status"),
        ("language_c", "zc_language", "language_c", "language"),
        (
            "sexual_orientatn_c",
            "zc_sexual_orientation",
            "sexual_orientation_c",
            "sexual_orientation",
        ),
        ("gender_identity_c", "zc_gender_identity", "gender_identity_c", "gender_ident"),
        ("pat_status_c", "zc_patient_status", "patient_status_c", "patient_status"),
    ):
        df = decode(df, s.src(table), on, code, alias)
    address = incomplete_address(F.col("add_line_1"), F.col("city"), F.col("zip"))
    return df.select(
        "study_id",
        "pat_id",
        "first_hiv_dx_date",
        "first_hiv_lab_date",
        "cohort_type",
        "birth_date",
        "email_address",
        "work_phone",
        "home_phone",
        "cur_pcp_prov_id",
        "pat_mrn_id",
        "sex",
        "marital_status_c",
        "marital_status",
        "language_c",
        "language",
        "sexual_orientatn_c",
        "sexual_orientation",
        "gender_identity_c",
        "gender_ident",
        "pat_status_c",
        "patient_status",
        "add_line_1",
        "add_line_2",
        "city",
        "zip",
        address.alias("incomplete_address"),
    ).distinct()


@stage("Patients race records", stored=True)
def patient_race(s: Study) -> DataFrame:
    races = s.src("patient_race").select("pat_id", "patient_race_c")
    df = s("cohort").select("pat_id").join(races, "pat_id", "left")
    return decode(
        df, s.src("zc_patient_race"), "patient_race_c", "patient_race_c", "race"
    ).distinct()


@stage("Patients ethnicity records", stored=True)
def patient_ethnicity(s: Study) -> DataFrame:
    groups = s.src("patient").select("pat_id", "ethnic_group_c")
    df = s("cohort").select("pat_id").join(groups, "pat_id", "left")
    return decode(
        df, s.src("zc_ethnic_group"), "ethnic_group_c", "ethnic_group_c", "ethnicity_group"
    ).distinct()


GEOCODE_COLUMNS = (
    "add_line_1",
    "city",
    "education_cd",
    "income_cd",
    "state",
    "zip",
    "x",
    "y",
    "state_fips",
    "cnty_fips",
    "stcofips",
    "tract",
    "tract_fips",
    "blkgrp",
    "fips",
    "update_date",
)


@stage("Patients geocoding records", stored=True)
def patient_geocode(s: Study) -> DataFrame:
    places = s.src("bip_pat_geocode").select("pat_id", *GEOCODE_COLUMNS)
    return places.transform(among, s("cohort"), "pat_id").distinct()
