"""Vitals, histories, problems, movements and appointments."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import age_years, choose_icd, windowed
from cohortforge.operators import among, decode, latest_records
from cohortforge.study import Study, stage


@stage("Flowsheet records", stored=True)
def vitals(s: Study) -> DataFrame:
    readings = (
        s.src("ip_flwsht_meas")
        .where(F.col("flo_meas_id").isin(*s.cfg.vital_measures))
        .where("meas_value <> ''")
        .transform(windowed, "recorded_time", s.cfg)
    )
    measures = s.src("ip_flo_gp_data").select(
        "flo_meas_id", F.col("disp_name").alias("measure_name"), "flo_meas_name"
    )
    templates = s.src("ip_flt_data").select(
        F.col("template_id").alias("flt_id"), F.col("display_name").alias("template_name")
    )
    visits = (
        s("encounters")
        .select("pat_id", "pat_enc_csn_id", "inpatient_data_id")
        .join(s("patient_table").select("pat_id"), "pat_id", "left_semi")
    )
    sheets = s.src("ip_flwsht_rec").select("inpatient_data_id", "fsd_id")
    return (
        readings.join(measures, "flo_meas_id")
        .join(templates, "flt_id")
        .join(visits.join(sheets, "inpatient_data_id"), "fsd_id")
        .select(
            "pat_id",
            "pat_enc_csn_id",
            "inpatient_data_id",
            "flt_id",
            "flo_meas_id",
            "template_name",
            "measure_name",
            "flo_meas_name",
            "recorded_time",
            F.col("meas_value").alias("measure_value"),
        )
        .distinct()
    )


SOCIAL_ANSWERS = (
    "female_partner_yn",
    "male_partner_yn",
    "condom_yn",
    "pill_yn",
    "diaphragm_yn",
    "iud_yn",
    "surgical_yn",
    "spermicide_yn",
    "implant_yn",
    "rhythm_yn",
    "injection_yn",
    "sponge_yn",
    "inserts_yn",
    "abstinence_yn",
    "iv_drug_user_yn",
    "illicit_drug_freq",
    "illicit_drug_cmt",
)


@stage("Latest social history", stored=True)
def latest_social_history(s: Study) -> DataFrame:
    """Lookups that feed no output column are left out: the rows are distinct."""
    people = s.src("patient").select("pat_id", "birth_date", "sex_c")
    history = s.src("social_hx").transform(among, s("cohort"), "pat_id")
    df = latest_records(history, "pat_id", "pat_enc_date_real").join(people, "pat_id")
    df = decode(df, s.src("zc_sex"), "sex_c", "rcpt_mem_sex_c", "gender")
    df = decode(
        df, s.src("zc_sexually_active"), "sexually_active_c", "sexually_active_c", "sexually_active"
    )
    return df.select(
        "pat_id",
        "pat_enc_csn_id",
        "pat_enc_date_real",
        "birth_date",
        age_years(F.col("birth_date"), s.cfg.as_of).alias("age"),
        "gender",
        "sexually_active",
        *SOCIAL_ANSWERS,
    ).distinct()


@stage("Latest family history", stored=True)
def latest_family_history(s: Study) -> DataFrame:
    ids = s("patient_table").select("pat_id", "study_id").distinct()
    history = s.src("family_hx").join(ids, "pat_id", "left_semi")
    df = latest_records(history, "pat_id", "pat_enc_date_real").join(ids, "pat_id")
    df = decode(df, s.src("zc_medical_hx"), "medical_hx_c", "medical_hx_c", "medical_hx")
    df = decode(df, s.src("zc_msg_caller_rel"), "relation_c", "msg_caller_rel_c", "relation")
    return df.select(
        "pat_id",
        "study_id",
        "pat_enc_csn_id",
        "line",
        "medical_hx_c",
        "medical_hx",
        "relation_c",
        "relation",
    ).distinct()


@stage("Problem list", stored=True)
def problem_list(s: Study) -> DataFrame:
    problems = (
        s.src("problem_list")
        .where("rec_archived_yn = 'N'")
        .transform(windowed, "noted_date", s.cfg)
        .withColumnRenamed("problem_ept_csn", "pat_enc_csn_id")
    )
    visits = s("encounters").select("pat_id", "pat_enc_csn_id", "effective_date_dt")
    staff = s.src("clarity_ser").select(
        F.col("user_id").alias("entry_user_id"), "prov_id", "prov_type"
    )
    specialties = s.src("v_cube_d_provider").select(
        F.col("provider_id").alias("prov_id"), "primary_specialty"
    )
    # staff meet their specialties first: the problems are shuffled for one of the lists
    staff = staff.join(specialties, "prov_id", "left")
    df = problems.join(visits, "pat_enc_csn_id").join(staff, "entry_user_id", "left")
    df = decode(
        df, s.src("zc_problem_status"), "problem_status_c", "problem_status_c", "problem_status"
    )
    df = decode(df, s.src("zc_hx_priority"), "priority_c", "hx_priority_c", "priority")
    return df.select(
        "pat_id",
        "pat_enc_csn_id",
        F.col("effective_date_dt").alias("encounter_date"),
        "problem_list_id",
        "dx_id",
        F.col("description").alias("prob_desc"),
        "noted_date",
        F.col("date_of_entry").alias("update_date"),
        "resolved_date",
        "problem_status",
        "problem_cmt",
        "priority",
        F.col("hospital_pl_yn").alias("hospital_problem"),
        F.col("principal_pl_yn").alias("principal_yn"),
        "prov_id",
        "prov_type",
        "primary_specialty",
    ).distinct()


@stage("Problem list diagnoses", stored=True)
def problem_list_dx(s: Study) -> DataFrame:
    def first_line(table: str, alias: str) -> DataFrame:
        return s.src(table).where("line = 1").select("dx_id", F.col("code").alias(alias))

    df = (
        s("problem_list")
        .join(first_line("edg_current_icd9", "code9"), "dx_id", "left")
        .join(first_line("edg_current_icd10", "code10"), "dx_id", "left")
    )

    def chosen(before, after):
        return choose_icd(F.col("noted_date"), before, after, s.cfg.icd_cutover)

    return df.select(
        "pat_id",
        "pat_enc_csn_id",
        F.lit("PROBLEM_LIST").alias("diagnosis_source"),
        "problem_list_id",
        F.col("noted_date").alias("diagnosis_date"),
        F.col("principal_yn").alias("primary_dx_yn"),
        "priority",
        "resolved_date",
        "update_date",
        "problem_status",
        chosen(F.lit(9), F.lit(10)).alias("icd_type"),
        chosen(F.col("code9"), F.col("code10")).alias("icd_code"),
    ).distinct()


@stage("Admissions, discharges and transfers", stored=True)
def adt_events(s: Study) -> DataFrame:
    """Not distinct: every movement row is kept."""
    moves = (
        s.src("clarity_adt")
        .where("event_type_c in (1, 3) and event_subtype_c <> 2")
        .transform(windowed, "effective_time", s.cfg)
    )
    stays = (
        s.src("pat_enc_hsp_2")
        .where("hsp_adm_event_id is not null")
        .select(
            "pat_enc_csn_id",
            F.col("hsp_adm_event_id").alias("adm_event_id"),
            F.col("hsp_dis_event_id").alias("dis_event_id"),
        )
    )
    outs = s.src("clarity_adt").select(
        F.col("event_id").alias("next_out_event_id"), F.col("effective_time").alias("time_out")
    )
    places = s.src("clarity_dep").select(
        "department_id",
        "department_name",
        "dept_abbreviation",
        F.col("specialty").alias("department_specialty"),
        "rev_loc_id",
    )
    df = (
        moves.join(s.src("lz_clarity_patient").select("pat_id"), "pat_id")
        .join(s.src("lz_clarity_enc").select("pat_enc_csn_id"), "pat_enc_csn_id")
        .join(stays, "pat_enc_csn_id")
        .join(outs, "next_out_event_id", "left")
        .join(places, "department_id", "left")
    )
    df = decode(df, s.src("clarity_loc"), "rev_loc_id", "loc_id", "loc_name", "loc_name")
    leaves = F.col("next_out_event_id") == F.col("dis_event_id")
    admit, out = F.col("event_type_c") == 1, F.col("event_type_c") == 3
    kind = (
        F.when(admit & leaves, "Admit/Discharge")
        .when(admit, "Admit")
        .when(out & leaves, "Discharge")
        .otherwise("Transfer")
    )
    return df.select(
        "pat_id",
        "pat_enc_csn_id",
        kind.alias("event_type"),
        F.col("event_id").alias("in_event_id"),
        "department_id",
        "department_name",
        "dept_abbreviation",
        "department_specialty",
        "rev_loc_id",
        "loc_name",
        F.col("effective_time").alias("time_in"),
        "time_out",
        F.col("next_out_event_id").alias("out_event_id"),
        "adm_event_id",
        "dis_event_id",
    )


@stage("Appointments", stored=True)
def appointments(s: Study) -> DataFrame:
    kinds = s.src("clarity_prc").select(
        "prc_id",
        F.col("record_type").alias("prc_v_type"),
        F.col("status").alias("prc_v_type_status"),
        F.col("prc_name").alias("visit_type"),
    )
    return (
        s.src("v_sched_appt")
        .transform(windowed, "checkin_dttm", s.cfg)
        .transform(among, s("cohort"), "pat_id")
        .join(kinds, "prc_id", "left")
        .select(
            "pat_id",
            "pat_enc_csn_id",
            "appt_status_c",
            F.col("appt_status_name").alias("appt_status"),
            "appt_conf_stat_c",
            F.col("appt_conf_stat_name").alias("appt_confirmation_status"),
            "appt_block_c",
            F.col("appt_block_name").alias("appt_block"),
            "appt_dttm",
            "appt_length",
            "appt_made_dttm",
            "prc_id",
            "prc_v_type",
            "prc_v_type_status",
            "visit_type",
            "checkin_dttm",
            "checkout_dttm",
            "cancel_reason_c",
            F.col("cancel_reason_name").alias("cancel_reason"),
            "appt_serial_num",
            "department_id",
            "department_name",
            "dept_specialty_c",
            F.col("dept_specialty_name").alias("department_specialty"),
            "loc_id",
            "loc_name",
            "center_c",
            "center_name",
            "prov_id",
            "prov_name_wid",
            "referring_prov_id",
            "referring_prov_name_wid",
        )
        .distinct()
    )
