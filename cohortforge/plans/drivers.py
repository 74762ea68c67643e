"""Driver and reference tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.operators import code_map
from cohortforge.study import Study, stage


@stage("Primary care departments", stored=True)
def primary_care_depts(s: Study) -> DataFrame:
    return (
        s.src("lz_clarity_dept")
        .where("primary_care = 1")
        .select("department_id", "department_name", "specialty")
        .distinct()
    )


@stage("Diagnosis code list", stored=True)
def dx_code_driver(s: Study) -> DataFrame:
    return s.src("dx_code_list").select("icd_type", "icd_code", "icd_desc", "dx_flag")


@stage("Diagnosis codes with their internal ids", stored=True)
def dx_driver_map(s: Study) -> DataFrame:
    ids = code_map(s.src("edg_current_icd9"), s.src("edg_current_icd10"))
    return (
        s("dx_code_driver")
        .join(ids, ["icd_type", "icd_code"])
        .select("dx_id", "icd_type", "icd_code", "icd_desc", "dx_flag")
        .distinct()
    )


@stage("Care providers", stored=True)
def care_providers(s: Study) -> DataFrame:
    return (
        s.src("v_cube_d_provider")
        .where(F.upper("provider_type") == s.cfg.care_provider_type)
        .select(
            "provider_id",
            "provider_name",
            "provider_display_name",
            "provider_type",
            "staff_resource",
            "primary_specialty",
            "is_resident_yn",
            "clinician_title",
        )
        .distinct()
    )


@stage("Laboratory codes with their rule step", stored=True)
def lab_rule_driver(s: Study) -> DataFrame:
    """Blank codes match nothing and repeats multiply rows, so both go."""
    return s.src("lab_rule_list").where("loinc <> ''").select("loinc", "step").distinct()


@stage("Chosen medications", stored=True)
def med_selection_driver(s: Study) -> DataFrame:
    """Stored, so that its size is known where the orders meet it."""
    return s.src("med_selection_list")


@stage("Chosen labs", stored=True)
def lab_selection_driver(s: Study) -> DataFrame:
    return s.src("lab_selection_list")
