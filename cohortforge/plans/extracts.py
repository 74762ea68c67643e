"""De-identified extracts. Identified on purpose: identifiers and disclosure list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.config import VISIT_TYPES
from cohortforge.functions import (
    age_years,
    as_text_date,
    concat_present,
    decode_value,
)
from cohortforge.operators import deidentify
from cohortforge.study import Study, stage

IDENTIFIED = ("extract_identifiers", "extract_disclosure_list")


def private(s: Study, name: str, link: bool = True) -> DataFrame:
    """A stage without its patient ids, for extracts that end in DISTINCT."""
    return deidentify(s(name), s("patient_table"), s.src("bip_encounter_link") if link else None)


def provider_key(s: Study, role: str, alias: str) -> DataFrame:
    """Provider study ids under the column that names the provider's role."""
    keys = s("providers").select(
        F.col("provider_id").alias(role), F.col("prov_study_id").alias(alias)
    )
    return keys.distinct()


def code_descriptions(s: Study) -> DataFrame:
    return s.src("lz_dx_px_lookup").select(
        F.col("code").alias("icd_code"), "icd_type", "icd_desc"
    )


def renamed(**names: str) -> list[Column]:
    return [F.col(old).alias(new) for new, old in names.items()]


@stage("Identifiers extract")
def extract_identifiers(s: Study) -> DataFrame:
    people = s("patient_table").select(
        "pat_id",
        "study_id",
        "birth_date",
        "first_hiv_dx_date",
        "first_hiv_lab_date",
        "incomplete_address",
    )
    mrn = s.src("lz_clarity_patient").select("pat_id", F.col("pat_mrn_id").alias("mrn"))
    names = s.src("patient").select("pat_id", F.col("pat_name").alias("patient_name"))
    places = s("patient_geocode").select(
        "pat_id",
        F.col("add_line_1").alias("address"),
        "city",
        "zip",
        "education_cd",
        "income_cd",
        "state",
        "x",
        "y",
        "state_fips",
        "cnty_fips",
        "stcofips",
        "tract",
        concat_present(F.col("stcofips"), F.col("tract")).alias("tract_fips"),
        "blkgrp",
        "fips",
    )
    df = people.join(mrn, "pat_id", "left").join(places, "pat_id", "left").join(names, "pat_id")
    dates = ("birth_date", "first_hiv_dx_date", "first_hiv_lab_date")
    df = df.withColumns({name: as_text_date(F.col(name)) for name in dates})
    return df.select(
        "study_id",
        "mrn",
        "birth_date",
        "patient_name",
        "first_hiv_dx_date",
        "first_hiv_lab_date",
        "address",
        "city",
        "zip",
        "incomplete_address",
        "education_cd",
        "income_cd",
        "state",
        "x",
        "y",
        "state_fips",
        "cnty_fips",
        "stcofips",
        "tract",
        "tract_fips",
        "blkgrp",
        "fips",
    ).distinct()


@stage("Demographics extract")
def extract_demographics(s: Study) -> DataFrame:
    """Age at the earlier piece of evidence. Coverage feeds no column, so it is not read."""
    first = F.least("first_hiv_dx_date", "first_hiv_lab_date")
    people = s("patient_table").select(
        "pat_id",
        "study_id",
        age_years(F.col("birth_date"), first).alias("age"),
        "marital_status",
        "sexual_orientation",
        F.col("patient_status").alias("vital_status"),
        "cohort_type",
    )
    profile = s.src("lz_clarity_patient").select(
        "pat_id",
        F.col("sex").alias("gender"),
        "ethnic_group",
        "mapped_race_name",
        "cur_pcp_prov_id",
    )
    last = (
        s("encounters")
        .groupBy("pat_id")
        .agg(F.year(F.max("effective_date_dt")).alias("year_last_encounter"))
    )
    pcp = (
        s("providers")
        .select(F.col("provider_id").alias("cur_pcp_prov_id"), "prov_study_id", "uc_provider")
        .distinct()
    )
    # the last encounter hangs on the profile row: without one it is unknown
    profile = profile.join(last, "pat_id", "left").join(pcp, "cur_pcp_prov_id", "left")
    return (
        people.join(profile, "pat_id", "left")
        .select(
            "study_id",
            "age",
            "gender",
            "ethnic_group",
            "mapped_race_name",
            "marital_status",
            "sexual_orientation",
            "vital_status",
            "year_last_encounter",
            "prov_study_id",
            "uc_provider",
            "cohort_type",
        )
        .distinct()
    )


@stage("Encounters extract")
def extract_encounters(s: Study) -> DataFrame:
    kinds = s.src("lz_enc_visit_types").select("pat_enc_csn_id", F.col("visit_type").alias("code"))
    return (
        private(s, "encounters")
        .join(kinds, "pat_enc_csn_id", "left")
        .join(provider_key(s, "visit_prov_id", "visit_prov_study_id"), "visit_prov_id", "left")
        .join(provider_key(s, "pcp_prov_id", "pcp_prov_study_id"), "pcp_prov_id", "left")
        .select(
            "study_id",
            "encounter_num",
            "encounter_type",
            "disposition",
            "ed_disposition",
            as_text_date(F.col("effective_date_dt")).alias("encounter_date"),
            F.col("hosp_admsn_time").alias("admit_date"),
            F.col("hosp_dischrg_time").alias("discharge_date"),
            decode_value(F.col("code"), VISIT_TYPES).alias("visit_type"),
            "visit_prov_study_id",
            "pcp_prov_study_id",
            F.col("specialty").alias("department_specialty"),
            "department_name",
            F.col("loc_name").alias("location"),
        )
        .distinct()
    )


@stage("Diagnoses extract")
def extract_diagnoses(s: Study) -> DataFrame:
    return (
        private(s, "diagnosis_fact")
        .join(code_descriptions(s), ["icd_code", "icd_type"], "left")
        .select(
            "study_id",
            "encounter_num",
            as_text_date(F.col("contact_date")).alias("diagnosis_date"),
            "icd_type",
            "icd_code",
            "icd_desc",
            "primary_sec_flag",
            "poa_flag",
            "hsp_final_dx_flag",
            "admit_dx_flag",
        )
        .distinct()
    )


@stage("Procedures extract")
def extract_procedures(s: Study) -> DataFrame:
    return (
        private(s, "procedure_fact")
        .join(provider_key(s, "proc_perf_prov_id", "prov_study_id"), "proc_perf_prov_id", "left")
        .select(
            "study_id",
            "encounter_num",
            as_text_date(F.col("proc_date")).alias("proc_date"),
            "code_type",
            F.col("proc_code").alias("procedure_code"),
            F.col("proc_name").alias("procedure_name"),
            "prov_study_id",
        )
        .distinct()
    )


@stage("Flowsheets extract")
def extract_vitals(s: Study) -> DataFrame:
    return (
        private(s, "vitals")
        .select(
            "study_id",
            "encounter_num",
            "recorded_time",
            *renamed(vital_sign_type="measure_name", vital_sign_value="measure_value"),
        )
        .distinct()
    )


@stage("Labs extract")
def extract_labs(s: Study) -> DataFrame:
    mapping = s.src("lz_clarity_labs").select(
        "order_proc_id", "proc_id", "component_id", F.col("bip_loinc_mapping").alias("loinc_code")
    )
    return (
        private(s, "select_labs")
        .join(mapping, ["order_proc_id", "proc_id", "component_id"], "left")
        .select(
            "study_id",
            "encounter_num",
            "proc_id",
            "description",
            "component_id",
            "component_name",
            "order_time",
            "result_time",
            F.col("ord_value").alias("results"),
            "reference_unit",
            "reference_low",
            "reference_high",
            "loinc_code",
            "harm_text_val",
            "ord_num_value",
            "harm_num_val",
            "harm_sign",
            "ref_normal_vals",
        )
        .distinct()
    )


@stage("Medications extract")
def extract_medications(s: Study) -> DataFrame:
    return (
        private(s, "select_medications")
        .select(
            "study_id",
            "encounter_num",
            "order_med_id",
            F.coalesce("taken_time", "order_inst").alias("taken_time_order_date"),
            "order_start_time",
            "order_end_time",
            "medication_name",
            "generic_name",
            "sig",
            F.col("hv_discrete_dose").alias("dose"),
            "refills",
            "quantity",
            "dose_unit",
            F.col("freq_name").alias("frequency"),
            "pharm_class",
            "pharm_subclass",
        )
        .distinct()
    )


@stage("Social history extract")
def extract_social_history(s: Study) -> DataFrame:
    return (
        private(s, "latest_social_history", link=False)
        .select(
            "study_id",
            "sexually_active",
            "female_partner_yn",
            "male_partner_yn",
            "iv_drug_user_yn",
            "illicit_drug_freq",
            "illicit_drug_cmt",
        )
        .distinct()
    )


@stage("Providers extract")
def extract_providers(s: Study) -> DataFrame:
    names = s.src("v_cube_d_provider").select("provider_id", "provider_name")
    df = s("providers").drop("provider_name").join(names, "provider_id", "left")
    report = df.select(
        "prov_study_id",
        "provider_name",
        "primary_specialty",
        "provider_type",
        "uc_provider",
        "active_providers",
        "hiv_provider",
    )
    return report.distinct()


@stage("Problem list extract")
def extract_problem_list(s: Study) -> DataFrame:
    """Shows the raw provider id, as the receiving sites expect."""
    known = s("providers").select("provider_id").distinct()
    return (
        private(s, "problem_list")
        .join(known, F.col("prov_id") == F.col("provider_id"), "left")
        .select(
            "study_id",
            "encounter_num",
            "encounter_date",
            "problem_list_id",
            "prob_desc",
            "noted_date",
            F.col("update_date").alias("date_of_entry"),
            "resolved_date",
            "problem_status",
            "problem_cmt",
            "priority",
            "hospital_problem",
            "principal_yn",
            "provider_id",
        )
        .distinct()
    )


@stage("Problem list diagnoses extract")
def extract_problem_dx(s: Study) -> DataFrame:
    return (
        private(s, "problem_list_dx")
        .join(code_descriptions(s), ["icd_code", "icd_type"], "left")
        .select(
            "study_id",
            "encounter_num",
            "diagnosis_source",
            "icd_type",
            "icd_code",
            "icd_desc",
            as_text_date(F.col("diagnosis_date")).alias("diagnosis_date"),
            as_text_date(F.col("resolved_date")).alias("resolved_date"),
            "priority",
            "problem_status",
            "primary_dx_yn",
        )
        .distinct()
    )


@stage("Movements extract")
def extract_adt(s: Study) -> DataFrame:
    report = (
        private(s, "adt_events")
        .select(
            "study_id",
            "encounter_num",
            "event_type",
            "time_in",
            "time_out",
            "department_id",
            "department_name",
            "department_specialty",
            F.col("loc_name").alias("location"),
        )
        .distinct()
    )
    return report


@stage("Family history extract")
def extract_family_history(s: Study) -> DataFrame:
    return (
        private(s, "latest_family_history")
        .select("study_id", "encounter_num", "line", "medical_hx", "relation")
        .distinct()
    )


def with_specimen_source(s: Study, df: DataFrame) -> DataFrame:
    sources = s.src("zc_specimen_source").select(
        "specimen_source_c", F.col("name").alias("specimen_source")
    )
    return df.join(sources, "specimen_source_c", "left")


def report_comments(s: Study, name: str, prefix: str) -> DataFrame:
    """Comment lines keyed like the result line they belong to."""
    return s(name).select(
        F.col(f"{prefix}_order_id").alias("order_proc_id"),
        F.col(f"{prefix}_line").alias("line"),
        f"{prefix}_sorting",
        F.col(f"{prefix}_line_comment").alias("line_comment"),
        F.col(f"{prefix}_results_cmt").alias("results_cmt"),
    )


@stage("Microbiology extract")
def extract_microbiology(s: Study) -> DataFrame:
    organisms = s.src("clarity_organism").select(
        F.col("organism_id").alias("lrr_based_organ_id"), F.col("name").alias("organism_name")
    )
    orders = private(s, "order_procedures").join(
        report_comments(s, "micro_comments", "micro"), ["order_proc_id", "line"]
    )
    report = (
        with_specimen_source(s, orders)
        .join(organisms, "lrr_based_organ_id", "left")
        .select(
            "study_id",
            "encounter_num",
            "order_proc_id",
            "order_time",
            "result_time",
            F.col("proc_code").alias("procedure_code"),
            F.col("description").alias("procedure_name"),
            "specimen_source",
            "specimen_type",
            "line",
            F.col("ord_value").alias("results"),
            F.col("component_name").alias("component"),
            "component_comment",
            "organism_name",
            "micro_sorting",
            "line_comment",
            "results_cmt",
        )
        .distinct()
    )
    return report


@stage("Susceptibility extract")
def extract_susceptibility(s: Study) -> DataFrame:
    """Only the patient of an order is needed, so its result rows collapse first."""
    owners = s("order_procedures").select("order_proc_id", "pat_id").distinct()
    report = (
        deidentify(s("micro_susceptibility").join(owners, "order_proc_id"), s("patient_table"))
        .select(
            "study_id", "order_proc_id", "organism_name", "susceptibility", "sensitivity", "antibiotic"
        )
        .distinct()
    )
    return report


@stage("Pathology extract")
def extract_pathology(s: Study) -> DataFrame:
    orders = private(s, "order_procedures").join(
        report_comments(s, "path_comments", "path"), ["order_proc_id", "line"]
    )
    report = (
        with_specimen_source(s, orders)
        .select(
            "study_id",
            "encounter_num",
            F.col("acc_num").alias("accession_num"),
            "order_proc_id",
            "order_time",
            "result_time",
            F.col("proc_name").alias("procedure_name"),
            "specimen_source",
            "specimen_type",
            "line",
            F.col("ord_value").alias("results"),
            F.col("component_name").alias("component"),
            "component_comment",
            "line_comment",
            "results_cmt",
        )
        .distinct()
    )
    return report


@stage("Imaging extract")
def extract_imaging(s: Study) -> DataFrame:
    """Orders and images collapse to one row per order before they meet."""
    owners = s("order_procedures").select("order_proc_id", "pat_id", "pat_enc_csn_id").distinct()
    images = (
        s("imaging_orders")
        .select(
            "order_proc_id", "order_time", "result_time", "proc_id", "proc_code", "proc_name", "acc_num"
        )
        .distinct()
    )
    report = (
        deidentify(
            owners.join(images, "order_proc_id"), s("patient_table"), s.src("bip_encounter_link")
        )
        .select(
            "study_id",
            "encounter_num",
            "order_proc_id",
            "order_time",
            "result_time",
            "proc_id",
            "proc_code",
            F.col("proc_name").alias("procedure_name"),
            F.col("acc_num").alias("accession_num"),
        )
        .distinct()
    )
    return report


@stage("Narratives extract")
def extract_narratives(s: Study) -> DataFrame:
    report = private(s, "imaging_narratives", link=False).select(
        "study_id", "order_proc_id", *renamed(line="narr_line", narrative="narr_narrative")
    )
    return report.distinct()


@stage("Impressions extract")
def extract_impressions(s: Study) -> DataFrame:
    report = private(s, "imaging_impressions", link=False).select(
        "study_id", "order_proc_id", *renamed(line="impr_line", impression="impr_impression")
    )
    return report.distinct()


@stage("Appointments extract")
def extract_appointments(s: Study) -> DataFrame:
    report = (
        private(s, "appointments")
        .join(provider_key(s, "prov_id", "appointment_prov_study_id"), "prov_id", "left")
        .join(
            provider_key(s, "referring_prov_id", "referring_prov_study_id"),
            "referring_prov_id",
            "left",
        )
        .select(
            "study_id",
            "encounter_num",
            "appt_dttm",
            "appt_made_dttm",
            "department_id",
            "department_name",
            "department_specialty",
            "center_name",
            "loc_name",
            "prov_name_wid",
            "referring_prov_name_wid",
            F.col("visit_type").alias("procedure_name"),
            "appt_confirmation_status",
            "appt_status",
            "appointment_prov_study_id",
            "referring_prov_study_id",
        )
        .distinct()
    )
    return report


COVERAGE_COLUMNS = ("financial_class_name", "mem_eff_from_date", "mem_eff_to_date")


@stage("Patient coverage extract")
def extract_patient_coverage(s: Study) -> DataFrame:
    """Repeats are kept."""
    cover = s.src("lz_clarity_coverage_pat").select("pat_id", *COVERAGE_COLUMNS)
    report = deidentify(cover, s("patient_table"), keep_repeats=True)
    return report.select("study_id", *COVERAGE_COLUMNS)


@stage("Encounter coverage extract")
def extract_encounter_coverage(s: Study) -> DataFrame:
    """Repeats are kept; the account is the one on the source encounter."""
    cover = (
        s.src("lz_clarity_coverage_enc")
        .where("financial_class_name is not null")
        .select("hsp_account_id", "line", *COVERAGE_COLUMNS)
    )
    accounts = s.src("pat_enc").select("pat_enc_csn_id", "hsp_account_id")
    visits = s("encounters").select("pat_id", "pat_enc_csn_id").join(accounts, "pat_enc_csn_id")
    report = deidentify(
        visits.join(cover, "hsp_account_id"),
        s("patient_table"),
        s.src("bip_encounter_link"),
        keep_repeats=True,
    )
    columns = ("study_id", "encounter_num", "line")
    return report.select(*columns, *COVERAGE_COLUMNS)


@stage("Disclosure list")
def extract_disclosure_list(s: Study) -> DataFrame:
    return (
        s.src("patient")
        .join(s("patient_table"), "pat_id", "left_semi")
        .select("pat_mrn_id", "pat_last_name", "pat_first_name")
        .distinct()
    )
