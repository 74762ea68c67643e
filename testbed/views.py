"""Health-record tables derived from the test tables, as SQL both engines accept.

Every view reads its whole test table; roles and codes come from column values.
`@DAYS(x)` is the day number since 1990-01-01, `@TS` the plain timestamp type.
Movement, reading and history times are the event times shifted into the study
window, so the window's upper bound cuts within a day.
"""

from __future__ import annotations

import re

BASE_TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "conversations",
)

VIEWS: dict[str, str] = {}

# --- people ---------------------------------------------------------------

VIEWS["patient"] = """
select cast(c_custkey as string) as pat_id,
  case when c_acctbal < -980 then null
    else cast(date '1930-01-01' + cast(c_custkey * 7919 % 29000 as int) as @TS) end as birth_date,
  lower(c_name) || '@example.org' as email_address,
  'W' || cast(c_custkey as string) as work_phone,
  'H' || cast(c_custkey as string) as home_phone,
  cast(c_custkey % 120 as string) as cur_pcp_prov_id,
  'M' || cast(c_custkey as string) as pat_mrn_id,
  case when c_acctbal >= 4500 then 'Female' else 'Male' end as sex,
  cast(case when c_acctbal >= 4500 then 1 else 2 end as bigint) as sex_c,
  cast(length(c_mktsegment) - 5 as bigint) as marital_status_c,
  cast(c_nationkey + 3 as bigint) as language_c,
  cast(c_nationkey as bigint) as empy_status_c,
  cast(c_nationkey as bigint) as state_c,
  cast(length(c_mktsegment) as bigint) as ethnic_group_c,
  cast(case when c_acctbal < 0 then 2 else 1 end as bigint) as pat_status_c,
  case c_nationkey when 0 then null when 1 then 'PO Box 12' when 2 then 'Homeless' when 3 then '.'
    when 4 then 'no street' when 5 then 'Address Unknown' when 10 then 'Mail returned'
    else cast(c_custkey as string) || ' Main St' end as add_line_1,
  'Unit ' || cast(c_nationkey as string) as add_line_2,
  case c_nationkey when 11 then null when 12 then 'No City' when 13 then 'Bad#Town'
    when 14 then 'return-mail' when 15 then '00' else 'City ' || c_mktsegment end as city,
  case c_nationkey when 16 then null when 17 then '123' when 18 then '###12'
    else cast(10000 + c_custkey % 80000 as string) end as zip,
  c_name as pat_name,
  'Last' || cast(c_custkey % 500 as string) as pat_last_name,
  'First' || cast(c_nationkey as string) as pat_first_name
from {customer}"""

VIEWS["patient_3"] = """
select cast(c_custkey as string) as pat_id,
  case when c_acctbal < -500 then 'Y' else 'N' end as is_test_pat_yn
from {customer}"""

VIEWS["patient_4"] = """
select cast(c_custkey as string) as pat_id, cast(c_nationkey % 7 as bigint) as gender_identity_c
from {customer}"""

VIEWS["patient_fyi_flags"] = """
select cast(c_custkey as string) as patient_id, cast(c_nationkey as bigint) as pat_flag_type_c
from {customer}"""

VIEWS["pat_sexual_orientation"] = """
select cast(c_custkey as string) as pat_id, cast(c_nationkey % 7 as bigint) as sexual_orientatn_c
from {customer}
union all
select cast(c_custkey as string) as pat_id, cast(1 as bigint) as sexual_orientatn_c
from {customer} where c_mktsegment = 'MACHINERY'"""

VIEWS["patient_race"] = """
select distinct cast(o_custkey as string) as pat_id,
  cast(length(o_orderpriority) as bigint) as patient_race_c
from {orders}"""

VIEWS["bip_pat_geocode"] = """
select cast(c_custkey as string) as pat_id,
  cast(c_custkey as string) || ' Main St' as add_line_1,
  'City ' || c_mktsegment as city,
  'E' || cast(c_nationkey % 4 as string) as education_cd,
  case when c_acctbal < 0 then null else 'I' || cast(c_nationkey % 3 as string) end as income_cd,
  n_name as state,
  cast(10000 + c_custkey % 80000 as string) as zip,
  c_acctbal as x,
  c_acctbal / 2 as y,
  cast(n_regionkey as string) as state_fips,
  cast(c_nationkey as string) as cnty_fips,
  case when c_acctbal > 9500 then null
    else cast(n_regionkey as string) || cast(c_nationkey as string) end as stcofips,
  case when c_mktsegment = 'FURNITURE' then null else 'T' || c_mktsegment end as tract,
  cast(n_regionkey as string) || '-' || c_mktsegment as tract_fips,
  'B' || cast(c_nationkey as string) as blkgrp,
  'F' || cast(c_nationkey as string) as fips,
  cast(date '2019-01-01' as @TS) as update_date
from {customer} join {nation} on c_nationkey = n_nationkey"""

VIEWS["lz_clarity_patient"] = """
select cast(c_custkey as string) as pat_id,
  'M' || cast(c_custkey as string) as pat_mrn_id,
  case when c_acctbal >= 4500 then 'Female' else 'Male' end as sex,
  case when c_acctbal < 0 then null else 'Group ' || c_mktsegment end as ethnic_group,
  'Race ' || cast(c_nationkey % 6 as string) as mapped_race_name,
  cast(c_custkey % 120 as string) as cur_pcp_prov_id,
  c_mktsegment as marital_status,
  'Gender ' || cast(c_nationkey % 3 as string) as gender_ident,
  case when c_acctbal > 9000 then null else 'Orient ' || cast(c_nationkey % 5 as string) end as sexual_orient,
  case when c_acctbal < -980 then null
    else cast(date '1930-01-01' + cast(c_custkey * 7919 % 29000 as int) as @TS) end as birth_date
from {customer}"""

# --- diagnoses ------------------------------------------------------------

VIEWS["edg_current_icd9"] = """
select p_partkey as dx_id,
  case when p_size = 50 then 'IMO0' else '' end || p_brand || '.' || cast(p_size % 4 as string) as code,
  1 as line
from {part}"""

VIEWS["edg_current_icd10"] = """
select p_partkey as dx_id,
  case when p_size = 50 then 'IMO0' else '' end || p_brand || '.' || cast(p_size % 3 as string) as code,
  1 as line
from {part}
union all
select p_partkey as dx_id, p_brand || '.9' as code, 2 as line
from {part} where p_type = 'PROMO'"""

VIEWS["dx_code_list"] = """
select distinct 9 as icd_type, p_brand || '.' || cast(p_size % 4 as string) as icd_code,
  'Diagnosis ' || p_brand as icd_desc,
  case p_brand when 'Brand#4' then 'TARGET' when 'Brand#5' then 'MENTAL' else 'OTHER' end as dx_flag
from {part} where p_brand in ('Brand#4', 'Brand#5', 'Brand#6')
union
select distinct 10 as icd_type, p_brand || '.' || cast(p_size % 3 as string) as icd_code,
  'Diagnosis ' || p_brand as icd_desc,
  case p_brand when 'Brand#4' then 'TARGET' when 'Brand#5' then 'MENTAL' else 'OTHER' end as dx_flag
from {part} where p_brand in ('Brand#4', 'Brand#5', 'Brand#6') and p_type <> 'SMALL'"""

VIEWS["pat_enc_dx"] = """
select cast(o_custkey as string) as pat_id, l_orderkey as pat_enc_csn_id, o_orderdate as contact_date,
  l_partkey as dx_id,
  case when l_linenumber = 1 then 'Y' when l_linenumber <= 5 then 'N' else null end as primary_dx_yn
from {lineitem} join {orders} on l_orderkey = o_orderkey"""

VIEWS["hsp_admit_diag"] = """
select cast(o_custkey as string) as pat_id, l_orderkey as pat_enc_csn_id,
  case l_returnflag when 'A' then l_partkey when 'R' then l_suppkey else null end as dx_id,
  case when l_discount = 0.1 then null else cast(@DAYS(o_orderdate) as double) end as pat_enc_date_real
from {lineitem} join {orders} on l_orderkey = o_orderkey"""

VIEWS["date_dimension"] = """
select distinct o_orderdate + interval 5 hour as calendar_dt,
  cast(@DAYS(o_orderdate) as double) as epic_dte
from {orders}"""

VIEWS["hsp_acct_dx_list"] = """
select l_orderkey as hsp_account_id,
  case when l_returnflag = 'R' then l_partkey else l_suppkey end as dx_id,
  cast(1 + (l_linenumber + l_partkey) % 4 as int) as line,
  cast(case when l_linestatus = 'F' then 1 else 2 end as bigint) as final_dx_poa_c
from {lineitem}"""

VIEWS["zc_dx_poa"] = """
select cast(1 as bigint) as dx_poa_c, 'Yes' as name union all select cast(2 as bigint), 'No'"""

VIEWS["lz_dx_px_lookup"] = """
select distinct code, 9 as icd_type, 'Nine ' || code as icd_desc from edg_current_icd9
where code not like 'Brand#7.%'
union all
select distinct code, 10 as icd_type, 'Ten ' || code as icd_desc from edg_current_icd10
where code not like 'Brand#8.%'"""

# --- encounters -----------------------------------------------------------

VIEWS["pat_enc"] = """
select cast(o_custkey as string) as pat_id, o_orderkey as pat_enc_csn_id, o_orderkey as hsp_account_id,
  o_orderkey as inpatient_data_id, o_orderkey + 5000000 as ip_episode_id,
  o_orderdate as effective_date_dt,
  case when o_orderstatus = 'F' then o_orderdate + interval 10 hour end as hosp_admsn_time,
  case when o_orderstatus = 'F' then o_orderdate + interval 80 hour end as hosp_dischrg_time,
  case when o_orderpriority = '3-MEDIUM' then null else o_orderkey % 7 end as visit_fc,
  case o_orderpriority when '5-LOW' then '' when '1-URGENT' then null else o_orderpriority end as enc_type_c,
  o_orderkey % 120 as department_id,
  cast(o_orderkey % 120 as string) as visit_prov_id,
  o_orderkey % 5 as appt_status_c,
  cast(o_custkey % 120 as string) as pcp_prov_id,
  o_orderkey % 6 as appt_prc_id
from {orders}"""

VIEWS["pat_enc_hsp"] = """
select o_orderkey as pat_enc_csn_id, o_orderkey % 7 as disch_disp_c, o_orderkey % 8 as ed_disposition_c
from {orders} where o_orderstatus = 'F'"""

VIEWS["pat_enc_hsp_2"] = """
select o_orderkey as pat_enc_csn_id,
  case when o_orderstatus = 'P' then null else o_orderkey end as hsp_adm_event_id,
  case when o_orderpriority in ('1-URGENT', '2-HIGH') then o_orderkey + 1 else o_orderkey + 2 end
    as hsp_dis_event_id
from {orders}"""

VIEWS["lz_clarity_enc"] = "select o_orderkey as pat_enc_csn_id from {orders}"

VIEWS["lz_enc_visit_types"] = """
select o_orderkey as pat_enc_csn_id,
  case o_orderkey % 14 when 0 then 'ED' when 1 then 'EI' when 2 then 'ES' when 3 then 'IP'
    when 4 then 'AV' when 5 then 'OT' when 6 then 'UN' when 7 then 'OA' when 8 then 'NI'
    when 9 then 'IS' when 10 then 'EO' when 11 then 'IO' when 12 then 'XX' else null end as visit_type
from {orders}"""

VIEWS["bip_encounter_link"] = """
select o_orderkey as encounter_ide, o_orderkey + 1000000 as encounter_num
from {orders} where o_orderstatus <> 'P'"""

# --- places, providers ----------------------------------------------------

VIEWS["lz_clarity_dept"] = """
select s_suppkey as department_id, 'Dept ' || s_name as department_name,
  'Specialty ' || cast(s_nationkey as string) as specialty,
  case when s_nationkey < 12 then 1 else 0 end as primary_care
from {supplier}"""

VIEWS["clarity_dep"] = """
select s_suppkey as department_id, 'Dept ' || s_name as department_name,
  'Specialty ' || cast(s_nationkey as string) as specialty,
  'D' || cast(s_suppkey as string) as dept_abbreviation,
  cast(s_nationkey % 7 as bigint) as rev_loc_id
from {supplier}"""

VIEWS["clarity_loc"] = """
select cast(r_regionkey as bigint) as loc_id, r_name as loc_name from {region}"""

VIEWS["clarity_prc"] = """
select cast(r_regionkey as bigint) as prc_id, 'Cat ' || r_name as proc_cat, 'Visit ' || r_name as prc_name,
  'T' || cast(r_regionkey as string) as record_type, 'Active' as status
from {region}"""

VIEWS["clarity_fc"] = """
select cast(r_regionkey as bigint) as financial_class, 'Class ' || r_name as fin_class_title
from {region}"""

VIEWS["v_cube_d_provider"] = """
select cast(s_suppkey as string) as provider_id, s_name as provider_name,
  'Dr ' || s_name as provider_display_name,
  case when s_nationkey % 2 = 0 then 'Physician' else 'Nurse' end as provider_type,
  'Person' as staff_resource,
  'Specialty ' || cast(s_nationkey as string) as primary_specialty,
  case when s_acctbal < 0 then 'Y' else 'N' end as is_resident_yn,
  case when s_nationkey % 2 = 0 then 'MD' else 'RN' end as clinician_title
from {supplier}"""

VIEWS["clarity_ser"] = """
select cast(s_suppkey as string) as prov_id,
  case when s_nationkey % 2 = 0 then 'Physician' else 'Nurse' end as prov_type,
  'U' || cast(s_suppkey as string) as user_id,
  case when s_acctbal >= 1000 then 'Active' else 'Inactive' end as active_status
from {supplier}"""

VIEWS["clarity_emp"] = """
select cast(s_suppkey as string) as prov_id, 'U' || cast(s_suppkey as string) as user_id,
  cast(1 as bigint) as user_status_c
from {supplier} where s_nationkey < 20
union all
select cast(s_suppkey as string) as prov_id, 'V' || cast(s_suppkey as string) as user_id,
  cast(2 as bigint) as user_status_c
from {supplier} where s_nationkey < 5"""

VIEWS["v_sched_appt"] = """
select cast(o_custkey as string) as pat_id, o_orderkey as pat_enc_csn_id,
  o_orderkey % 5 as appt_status_c, 'Status ' || cast(o_orderkey % 5 as string) as appt_status_name,
  o_orderkey % 3 as appt_conf_stat_c, 'Conf ' || cast(o_orderkey % 3 as string) as appt_conf_stat_name,
  o_orderkey % 4 as appt_block_c, 'Block ' || cast(o_orderkey % 4 as string) as appt_block_name,
  o_orderdate + interval 8 hour as appt_dttm,
  cast(15 + o_orderkey % 4 * 15 as int) as appt_length,
  o_orderdate - interval 240 hour as appt_made_dttm,
  o_orderkey % 6 as prc_id,
  o_orderdate + interval 9 hour as checkin_dttm,
  case when o_orderstatus = 'F' then o_orderdate + interval 10 hour end as checkout_dttm,
  case when o_orderstatus = 'O' then o_orderkey % 2 end as cancel_reason_c,
  case when o_orderstatus = 'O' then 'Reason ' || cast(o_orderkey % 2 as string) end as cancel_reason_name,
  'S' || cast(o_orderkey as string) as appt_serial_num,
  o_orderkey % 25 as department_id, 'Dept ' || cast(o_orderkey % 25 as string) as department_name,
  o_orderkey % 9 as dept_specialty_c, 'Spec ' || cast(o_orderkey % 9 as string) as dept_specialty_name,
  o_orderkey % 5 as loc_id, 'Loc ' || cast(o_orderkey % 5 as string) as loc_name,
  o_orderkey % 2 as center_c, 'Center ' || cast(o_orderkey % 2 as string) as center_name,
  cast(o_orderkey % 120 as string) as prov_id,
  'Prov [' || cast(o_orderkey % 120 as string) || ']' as prov_name_wid,
  cast(o_custkey % 70 as string) as referring_prov_id,
  'Prov [' || cast(o_custkey % 70 as string) || ']' as referring_prov_name_wid
from {orders}"""

# --- laboratory and reports -----------------------------------------------

VIEWS["order_proc"] = """
select o_orderkey as order_proc_id, cast(o_custkey as string) as pat_id, o_orderkey as pat_enc_csn_id,
  o_orderkey % 220 as proc_id, 'PC' || cast(o_orderkey % 220 as string) as proc_code,
  'Order ' || cast(o_orderkey % 220 as string) as description,
  o_orderdate + interval 9 hour as order_time,
  o_orderdate as ordering_date,
  o_orderdate + interval 54 hour as result_time,
  cast(case when o_orderstatus = 'O' then 2 else 5 end as bigint) as order_status_c,
  cast(case o_orderpriority when '1-URGENT' then 7 when '2-HIGH' then 26 when '3-MEDIUM' then 3
    when '4-NOT SPECIFIED' then 59 else 5 end as bigint) as order_type_c,
  case when o_orderstatus = 'P' then 'Y' else 'N' end as abnormal_yn,
  cast(case when o_orderpriority = '5-LOW' and o_orderstatus = 'F' then 99
    when o_orderpriority = '5-LOW' then 10 else null end as bigint) as radiology_status_c,
  o_orderkey % 7 as specimen_source_c,
  o_orderkey % 6 as specimen_type_c
from {orders}"""

VIEWS["order_proc_2"] = """
select o_orderkey as order_proc_id, o_orderdate + interval 7 hour as specimn_taken_time
from {orders} where o_totalprice > 20000"""

VIEWS["order_results"] = """
select l_orderkey as order_proc_id, cast(o_custkey as string) as pat_id, l_orderkey as pat_enc_csn_id,
  l_linenumber as line, l_suppkey % 7 as component_id,
  o_orderdate + interval 72 hour as result_date,
  o_orderdate + interval 60 hour as result_time,
  case (l_partkey + l_linenumber) % 13
    when 0 then 'NON-REACTIVE' when 1 then 'Positive ' when 2 then 'DETECTED'
    when 3 then 'NOT DETECTED' when 4 then '<' || cast(cast(l_quantity as int) as string)
    when 5 then '>=' || cast(cast(l_quantity as int) * 100 as string)
    when 6 then cast(cast(l_quantity as int) as string) || '.5%'
    when 7 then '12-19-08 6:45AM' when 8 then cast(cast(l_quantity as int) as string)
    when 9 then 'NEGATIVE' when 10 then '>10,' || cast(100 + cast(l_quantity as int) as string)
    when 11 then '< 20 copies' else case l_suppkey % 3 when 0 then '' when 1 then '  ' else null end
    end as ord_value,
  cast(case when (l_partkey + l_linenumber) % 13 in (6, 8) then cast(l_quantity as int)
    else 9999999 end as decimal(20, 10)) as ord_num_value,
  'copies/mL' as reference_unit, 'below ' || cast(l_linenumber as string) as ref_normal_vals,
  '0' as reference_low, '20' as reference_high,
  l_suppkey % 4 as result_flag_c,
  'c' || cast(l_linenumber as string) as component_comment,
  l_linenumber as result_val_start_ln, l_linenumber + 1 as result_val_end_ln,
  l_linenumber + 2 as result_cmt_start_ln, l_linenumber + 3 as result_cmt_end_ln,
  l_suppkey % 30 as lrr_based_organ_id
from {lineitem} join {orders} on l_orderkey = o_orderkey"""

VIEWS["clarity_component"] = """
select cast(n_nationkey as bigint) as component_id, 'Component ' || cast(n_nationkey as string) as name,
  'Common ' || cast(n_regionkey as string) as common_name,
  case when n_nationkey % 2 = 0 then cast(n_nationkey + 100 as bigint) end as default_lnc_id,
  case when n_nationkey % 2 = 0 then 'OLD' else 'L-' || cast(n_nationkey as string) end as loinc_code
from {nation}"""

VIEWS["lnc_db_main"] = """
select cast(n_nationkey + 100 as bigint) as record_id, 'L-' || cast(n_nationkey as string) as lnc_code
from {nation}"""

VIEWS["lab_rule_list"] = """
select case when p_size % 25 <= 5 then 'L-' || cast(p_size % 25 as string) else null end as loinc,
  'Panel ' || p_name as proc_description,
  'Component ' || cast(p_size % 25 as string) as component_name,
  case p_size % 25 when 0 then '2' when 1 then '1A' when 2 then '1B' when 3 then '1C' when 4 then '1D'
    when 5 then '1' when 6 then null else '2' end as step
from {part}"""

VIEWS["lab_selection_list"] = """
select p_partkey as proc_id, 'Order ' || cast(p_partkey as string) as description,
  cast(p_size % 7 as bigint) as component_id,
  'Component ' || cast(p_size % 7 as string) as component_name
from {part}"""

VIEWS["lz_clarity_labs"] = """
select l_orderkey as order_proc_id, l_orderkey % 220 as proc_id, l_suppkey % 7 as component_id,
  'L-' || cast(l_suppkey % 7 as string) as bip_loinc_mapping
from {lineitem} where l_returnflag <> 'N'"""

VIEWS["order_rad_acc_num"] = """
select o_orderkey as order_proc_id, 'ACC' || cast(o_orderkey as string) as acc_num
from {orders} where o_orderstatus = 'F'"""

VIEWS["order_res_comp_cmt"] = """
select conv_id as order_id, cast(turn as int) as line_comp,
  case when turn = 5 then '   ' else text end as results_comp_cmt,
  cast(turn + 1 as int) as line_comment
from {conversations}"""

VIEWS["order_res_comment"] = """
select o_orderkey as order_id, cast(1 + n_chars % 7 as int) as line,
  case when n_chars < 40 then ' ' else text end as results_cmt,
  cast(n_chars % 3 as int) as line_comment
from {documents} join {orders} on o_custkey = doc_id + 1"""

VIEWS["order_narrative"] = """
select o_orderkey as order_proc_id, cast(1 + n_chars % 4 as int) as line, text as narrative
from {documents} join {orders} on o_custkey = doc_id + 1
union all
select conv_id as order_proc_id, cast(turn + 5 as int) as line,
  case when role = 'user' then text else ' ' end as narrative
from {conversations}"""

VIEWS["order_impression"] = """
select conv_id as order_proc_id, cast(turn as int) as line, text as impression from {conversations}
union all
select o_orderkey as order_proc_id, 9 as line, source || ' ' || text as impression
from {documents} join {orders} on o_custkey = doc_id + 1"""

VIEWS["order_sensitivity"] = """
select l_orderkey as order_proc_id, l_linenumber as line,
  cast(cast(l_quantity as int) as string) as sensitivity_value,
  l_suppkey % 7 as suscept_c, l_partkey % 30 as antibiotic_c, l_suppkey % 30 as organism_id
from {lineitem}"""

VIEWS["clarity_organism"] = """
select cast(n_nationkey as bigint) as organism_id, 'Organism ' || n_name as name from {nation}"""

VIEWS["zc_order_type"] = """
select cast(3 as bigint) as order_type_c, 'Microbiology' as name
union all select cast(59 as bigint), 'Pathology'"""

# --- procedures -----------------------------------------------------------

VIEWS["hsp_acct_px_list"] = """
select l_orderkey as hsp_account_id, l_partkey as final_icd_px_id, l_shipdate as proc_date,
  case when l_tax = 0.0 then null else cast(l_suppkey as string) end as proc_perf_prov_id
from {lineitem}"""

VIEWS["cl_icd_px"] = """
select p_partkey as icd_px_id, p_name as procedure_name, p_brand || p_type as ref_bill_code,
  cast(p_size % 7 as bigint) as ref_bill_code_set_c
from {part}"""

VIEWS["arpb_transactions"] = """
select cast(o_custkey as string) as patient_id, l_orderkey as pat_enc_csn_id, l_shipdate as service_date,
  cast(10000 + l_partkey as string) as cpt_code, cast(l_suppkey as string) as serv_provider_id,
  cast(case when l_returnflag = 'R' then 2 else 1 end as bigint) as tx_type_c,
  case when l_tax > 0.07 then l_shipdate end as void_date
from {lineitem} join {orders} on l_orderkey = o_orderkey"""

VIEWS["clarity_eap"] = """
select p_partkey as proc_id, p_name as proc_name, cast(10000 + p_partkey as string) as proc_code
from {part} where p_type <> 'LARGE'"""

VIEWS["hsp_account"] = """
select o_orderkey as hsp_account_id, cast(o_custkey as string) as pat_id from {orders}"""

VIEWS["hsp_transactions"] = """
select l_orderkey * 10 + l_linenumber as tx_id, l_orderkey as hsp_account_id, l_orderkey as pat_enc_csn_id,
  l_shipdate as service_date,
  case when l_linestatus = 'F' then 'J' || cast(1000 + l_partkey as string) || 'XX'
    when l_tax < 0.04 then '' end as hcpcs_code,
  case when l_discount < 0.02 then cast(l_partkey as string)
    else cast(10000 + l_partkey as string) end as cpt_code,
  cast(l_suppkey as string) as performing_prov_id, l_partkey as proc_id,
  cast(case when l_returnflag = 'A' then 2 else 1 end as bigint) as tx_type_ha_c
from {lineitem}"""

VIEWS["f_arhb_inactive_tx"] = """
select l_orderkey * 10 + l_linenumber as tx_id from {lineitem} where l_tax >= 0.08"""

# --- medications ----------------------------------------------------------

VIEWS["order_med"] = """
select l_orderkey * 10 + l_linenumber as order_med_id, cast(o_custkey as string) as pat_id,
  l_orderkey as pat_enc_csn_id,
  o_orderdate + interval 8 hour as order_inst,
  o_orderdate as order_start_time,
  shipped as order_end_time,
  case when discount = 0.0 then 800001 when tax = 0.0 then null else partkey end as medication_id,
  suppkey as user_sel_med_id,
  quantity as hv_discrete_dose, quantity * 2 as med_dis_disp_qty,
  'Take ' || cast(l_linenumber as string) as sig,
  cast(cast(quantity as int) as string) as quantity, cast(l_linenumber as string) as refills,
  cast(l_linenumber as string) as hv_discr_freq_id,
  cast(l_linenumber as bigint) as hv_dose_unit_c,
  cast(l_linenumber + 1 as bigint) as order_status_c,
  cast(l_linenumber - 1 as bigint) as ordering_mode_c,
  cast(l_linenumber - 2 as bigint) as med_dis_disp_unit_c,
  cast(l_linenumber as bigint) as order_class_c,
  case when flag = 'N' then null else o_orderdate end as ordering_date,
  case when status = 'O' then null else o_orderdate end as start_date
from (
  select l_orderkey, l_linenumber, min(l_partkey) as partkey, min(l_suppkey) as suppkey,
    max(l_shipdate) as shipped, min(l_discount) as discount, max(l_tax) as tax,
    max(l_quantity) as quantity, max(l_returnflag) as flag, max(l_linestatus) as status
  from {lineitem} group by l_orderkey, l_linenumber) lines
join {orders} on l_orderkey = o_orderkey"""

VIEWS["order_medinfo"] = """
select l_orderkey * 10 + l_linenumber as order_med_id,
  min(case when l_linestatus = 'F' then l_suppkey end) as dispensable_med_id,
  max(l_shipdate) as last_admin_inst
from {lineitem} group by l_orderkey * 10 + l_linenumber"""

VIEWS["mar_admin_info"] = """
select l_orderkey * 10 + l_linenumber as order_med_id, l_quantity as infusion_rate,
  cast(l_linenumber as bigint) as mar_inf_rate_unit_c,
  l_shipdate + interval 7 hour as taken_time, l_suppkey % 30 as route_c
from {lineitem} where l_returnflag <> 'A'"""

VIEWS["zc_admin_route"] = """
select cast(n_nationkey as bigint) as med_route_c, 'Route ' || n_name as name,
  'R' || cast(n_nationkey as string) as abbr
from {nation}"""

VIEWS["ip_frequency"] = """
select cast(n_nationkey as string) as freq_id, 'Every ' || cast(n_nationkey as string) || ' h' as freq_name
from {nation} where n_regionkey <> 4"""

VIEWS["clarity_medication"] = """
select p_partkey as medication_id, p_name as name, p_name || ' generic' as generic_name,
  cast(p_size as bigint) as pharm_class_c, cast(p_size % 6 as bigint) as thera_class_c,
  cast(p_size % 27 as bigint) as pharm_subclass_c
from {part}"""

VIEWS["med_selection_list"] = """
select p_partkey as medication_id, p_name as medication_name, p_name || ' generic' as generic_name,
  cast(null as string) as pharm_class, cast(null as string) as thera_class,
  cast(null as string) as pharm_subclass
from {part} where p_type = 'PROMO'"""

# --- flowsheets, movements, histories, problems ---------------------------

VIEWS["ip_flwsht_rec"] = """
select o_orderkey as inpatient_data_id, o_orderkey as fsd_id from {orders}"""

VIEWS["ip_flwsht_meas"] = """
select event_id as fsd_id, cast(user_id % 27 as string) as flt_id,
  case event_type when 'view' then '11' when 'click' then '14' when 'signup' then '5'
    when 'purchase' then '8' else '999' end as flo_meas_id,
  ts - interval 8720 day as recorded_time,
  case when value < 1 then null else cast(value as string) end as meas_value
from {events}"""

VIEWS["ip_flo_gp_data"] = """
select '11' as flo_meas_id, 'Height' as disp_name, 'HEIGHT' as flo_meas_name
union all select '14', 'Weight', 'WEIGHT'
union all select '5', 'Blood Pressure', 'BP'
union all select '8', 'Pulse', 'PULSE'
union all select '999', 'Other', 'OTHER'"""

VIEWS["ip_flt_data"] = """
select cast(n_nationkey as string) as template_id, 'Template ' || n_name as display_name from {nation}"""

VIEWS["clarity_adt"] = """
select event_id, cast(user_id as string) as pat_id, event_id as pat_enc_csn_id,
  cast(case event_type when 'signup' then 1 when 'purchase' then 3 when 'view' then 1 when 'click' then 3
    else 4 end as bigint) as event_type_c,
  case when event_type = 'view' then null else event_id + 1 end as next_out_event_id,
  user_id % 120 as department_id,
  ts - interval 8720 day as effective_time,
  cast(case when value > 50 then 2 else 1 end as bigint) as event_subtype_c
from {events}"""

VIEWS["social_hx"] = """
select cast(user_id as string) as pat_id, event_id as pat_enc_csn_id,
  case when event_type = 'error' then null else cast(@DAYS(ts) as double) end as pat_enc_date_real,
  cast(user_id % 6 as bigint) as sexually_active_c,
  case when event_type = 'view' then 'Y' else 'N' end as female_partner_yn,
  case when event_type = 'click' then 'Y' else 'N' end as male_partner_yn,
  case when value > 10 then 'Y' else 'N' end as condom_yn,
  case when value > 20 then 'Y' else 'N' end as pill_yn,
  case when value > 30 then 'Y' else 'N' end as diaphragm_yn,
  case when value > 40 then 'Y' else 'N' end as iud_yn,
  case when value > 50 then 'Y' else 'N' end as surgical_yn,
  case when value > 60 then 'Y' else 'N' end as spermicide_yn,
  case when value > 70 then 'Y' else 'N' end as implant_yn,
  case when value > 80 then 'Y' else 'N' end as rhythm_yn,
  case when value > 90 then 'Y' else 'N' end as injection_yn,
  case when value < 10 then 'Y' else 'N' end as sponge_yn,
  case when value < 20 then 'Y' else 'N' end as inserts_yn,
  case when value < 30 then 'Y' else 'N' end as abstinence_yn,
  case when event_type = 'purchase' then 'Y' else 'N' end as iv_drug_user_yn,
  event_type as illicit_drug_freq, props as illicit_drug_cmt,
  cast(1 as bigint) as tobacco_user_c, cast(1 as bigint) as smoking_tob_use_c,
  cast(1 as bigint) as alcohol_use_c
from {events}"""

VIEWS["social_hx_alc_use"] = """
select event_id as pat_enc_csn_id, cast(user_id % 3 as bigint) as hx_drink_types_c from {events}
union all
select event_id as pat_enc_csn_id, cast(9 as bigint) as hx_drink_types_c from {events}
where event_type = 'click'"""

VIEWS["family_hx"] = """
select cast(o_custkey as string) as pat_id, l_orderkey as pat_enc_csn_id, l_linenumber as line,
  l_suppkey % 30 as medical_hx_c, l_partkey % 7 as relation_c,
  case when l_tax = 0.0 then null else cast(@DAYS(o_orderdate) as double) end as pat_enc_date_real
from {lineitem} join {orders} on l_orderkey = o_orderkey"""

VIEWS["problem_list"] = """
select l_orderkey * 10 + l_linenumber as problem_list_id, l_partkey as dx_id,
  'Problem ' || cast(l_partkey as string) as description,
  l_shipdate as noted_date, l_shipdate + interval 24 hour as date_of_entry,
  case when l_returnflag = 'A' then null else l_shipdate + interval 720 hour end as resolved_date,
  'Comment ' || cast(l_linenumber as string) as problem_cmt,
  case when l_linestatus = 'F' then 'Y' else 'N' end as hospital_pl_yn,
  case when l_linenumber = 1 then 'Y' else 'N' end as principal_pl_yn,
  l_orderkey as problem_ept_csn, 'U' || cast(l_suppkey % 110 as string) as entry_user_id,
  cast(l_linenumber as bigint) as problem_status_c, cast(l_linenumber - 2 as bigint) as priority_c,
  case when l_returnflag = 'R' then 'Y' else 'N' end as rec_archived_yn
from {lineitem}"""

# --- coverage -------------------------------------------------------------

VIEWS["lz_clarity_coverage_pat"] = """
select cast(o_custkey as string) as pat_id, o_orderpriority as financial_class_name,
  o_orderdate as mem_eff_from_date,
  case when o_orderstatus = 'O' then null else o_orderdate + interval 8760 hour end as mem_eff_to_date
from {orders}"""

VIEWS["lz_clarity_coverage_enc"] = """
select l_orderkey as hsp_account_id, l_linenumber as line,
  case when l_returnflag = 'N' then null else 'Class ' || l_returnflag end as financial_class_name,
  l_shipdate as mem_eff_from_date,
  case when l_linestatus = 'O' then null else l_shipdate + interval 720 hour end as mem_eff_to_date
from {lineitem}"""

# --- common data model ----------------------------------------------------

VIEWS["measurement"] = """
select l_partkey as measurement_concept_id,
  case when l_linestatus = 'F' then 1000000000 + l_suppkey else null end as value_as_concept_id
from {lineitem}"""

VIEWS["concept"] = """
select p_partkey as concept_id, 'P' || cast(p_partkey as string) as concept_code, p_name as concept_name
from {part}
union all
select 1000000000 + s_suppkey as concept_id, 'S' || cast(s_suppkey as string) as concept_code,
  s_name as concept_name
from {supplier}"""

VIEWS["lab_code_list"] = """
select 'P' || cast(p_partkey as string) as concept_code from {part} where p_type in ('PROMO', 'LARGE')"""

# --- code dictionaries over region (codes 0-4) and nation (0-24) ----------

for _name, _code in (
    ("zc_marital_status", "marital_status_c"),
    ("zc_sexual_orientation", "sexual_orientation_c"),
    ("zc_gender_identity", "gender_identity_c"),
    ("zc_patient_status", "patient_status_c"),
    ("zc_med_unit", "disp_qtyunit_c"),
    ("zc_order_status", "order_status_c"),
    ("zc_ordering_mode", "ordering_mode_c"),
    ("zc_order_class", "order_class_c"),
    ("zc_thera_class", "thera_class_c"),
    ("zc_disch_disp", "disch_disp_c"),
    ("zc_ed_disposition", "ed_disposition_c"),
    ("zc_hcd_code_set", "code_set_c"),
    ("zc_sex", "rcpt_mem_sex_c"),
    ("zc_sexually_active", "sexually_active_c"),
    ("zc_problem_status", "problem_status_c"),
    ("zc_hx_priority", "hx_priority_c"),
    ("zc_msg_caller_rel", "msg_caller_rel_c"),
    ("zc_specimen_type", "specimen_type_c"),
    ("zc_specimen_source", "specimen_source_c"),
    ("zc_suscept", "suscept_c"),
):
    VIEWS[_name] = (
        f"select cast(r_regionkey as bigint) as {_code}, '{_name[3:]} ' || r_name as name "
        "from {region}"
    )

for _name, _code in (
    ("zc_language", "language_c"),
    ("zc_patient_race", "patient_race_c"),
    ("zc_pharm_class", "pharm_class_c"),
    ("zc_pharm_subclass", "pharm_subclass_c"),
    ("zc_medical_hx", "medical_hx_c"),
    ("zc_antibiotic", "antibiotic_c"),
):
    VIEWS[_name] = (
        f"select cast(n_nationkey as bigint) as {_code}, '{_name[3:]} ' || n_name as name "
        "from {nation}"
    )

VIEWS["zc_ethnic_group"] = """
select cast(r_regionkey + 6 as bigint) as ethnic_group_c, 'ethnic ' || r_name as name from {region}"""

VIEWS["zc_disp_enc_type"] = """
select distinct o_orderpriority as disp_enc_type_c, 'Type ' || o_orderpriority as name
from {orders} where o_orderpriority <> '2-HIGH'"""

# --- the two dialects -----------------------------------------------------

_DIALECTS = {
    "spark": {"@TS": "timestamp_ntz", "@DAYS": r"datediff(\1, date '1990-01-01')"},
    "duckdb": {
        "@TS": "timestamp",
        "@DAYS": r"datediff('day', date '1990-01-01', cast(\1 as date))",
    },
}


def view_sql(name: str, dialect: str) -> str:
    """View text of one dialect; test tables stay as {name} place holders."""
    words = _DIALECTS[dialect]
    text = re.sub(r"@DAYS\(([^)]*)\)", words["@DAYS"], VIEWS[name])
    return text.replace("@TS", words["@TS"]).strip()
