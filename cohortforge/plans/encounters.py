"""Cohort encounters and their key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortforge.functions import windowed
from cohortforge.operators import among, decode, dense_key
from cohortforge.study import Study, stage


@stage("Encounters", stored=True)
def encounters(s: Study) -> DataFrame:
    visits = s.src("pat_enc").transform(windowed, "effective_date_dt", s.cfg)
    stays = s.src("pat_enc_hsp").select("pat_enc_csn_id", "disch_disp_c", "ed_disposition_c")
    places = s.src("clarity_dep").select(
        "department_id", "department_name", "specialty", "rev_loc_id"
    )
    visit_kinds = s.src("clarity_prc").select(
        F.col("prc_id").alias("appt_prc_id"), "proc_cat", "prc_name"
    )
    # stays come before people: both tables may be dealt out by encounter
    df = (
        visits.join(stays, "pat_enc_csn_id", "left")
        .transform(among, s("cohort"), "pat_id")
        .join(places, "department_id", "left")
        .join(visit_kinds, "appt_prc_id", "left")
    )
    for on, table, code, alias, value, default in (
        ("visit_fc", "clarity_fc", "financial_class", "financial_class", "fin_class_title", "Unknown"),
        ("enc_type_c", "zc_disp_enc_type", "disp_enc_type_c", "encounter_type", "name", "Unknown"),
        ("disch_disp_c", "zc_disch_disp", "disch_disp_c", "disposition", "name", None),
        ("ed_disposition_c", "zc_ed_disposition", "ed_disposition_c", "ed_disposition", "name", None),
        ("rev_loc_id", "clarity_loc", "loc_id", "loc_name", "loc_name", None),
    ):
        df = decode(df, s.src(table), on, code, alias, value, default)
    return df.select(
        "pat_id",
        "pat_enc_csn_id",
        "hsp_account_id",
        "inpatient_data_id",
        "ip_episode_id",
        "effective_date_dt",
        "hosp_admsn_time",
        "hosp_dischrg_time",
        F.coalesce("visit_fc", F.lit(-999)).alias("prim_fc"),
        "financial_class",
        F.coalesce("enc_type_c", F.lit("-999")).alias("enc_type_c"),
        "encounter_type",
        "department_id",
        "visit_prov_id",
        "appt_status_c",
        "pcp_prov_id",
        "disch_disp_c",
        "disposition",
        "ed_disposition_c",
        "ed_disposition",
        "department_name",
        "specialty",
        "loc_name",
        "appt_prc_id",
        "proc_cat",
        "prc_name",
    ).distinct()


@stage("Encounter key", stored=True)
def encounter_key(s: Study) -> DataFrame:
    earlier = s.keys.get("encounter_id")
    return dense_key(s("encounters"), "pat_enc_csn_id", "encounter_id", s.cfg.salt, earlier)
