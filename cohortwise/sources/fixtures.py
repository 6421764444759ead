"""Cohort-shaped test views over the given tables.

Each view is plain SQL that Spark and DuckDB both accept, with {table} for a given
table, so that a query and its SQL twin start from the same rows. Dates are moved 24
years forward; one order stands for one submission.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.sources import io

_MONTHS = "'JanFebMarAprMayJunJulAugSepOctNovDec'"


def _person(key: str) -> str:
    pad = f"lpad(CAST({key} AS STRING), 8, '0')"
    return f"CASE WHEN {key} % 97 = 0 THEN {pad} ELSE repeat('0', 52) || {pad} END"


def _day(ts: str, plus: str = "0") -> str:
    return f"CAST(CAST(CAST({ts} AS DATE) + INTERVAL 24 YEAR AS DATE) + CAST({plus} AS INT) AS STRING)"


def _dirty(s: str, k: str) -> str:
    """Text date s (yyyy-mm-dd) in one of eight spellings, by key k."""
    mon = f"substr({_MONTHS}, CAST(substr({s},6,2) AS INT)*3-2, 3)"
    dmy = f"substr({s},9,2) || '/' || substr({s},6,2) || '/' || substr({s},1,4)"
    return f"""CASE ({k}) % 8
  WHEN 0 THEN {dmy}
  WHEN 1 THEN {dmy} || ' 10:30'
  WHEN 2 THEN {mon} || ' ' || CAST(CAST(substr({s},9,2) AS INT) AS STRING) || ' ' || substr({s},1,4) || ' 11:30'
  WHEN 3 THEN substr({s},9,2) || '-' || substr({s},6,2) || '-' || substr({s},3,2)
  WHEN 4 THEN {s} || ' 00:00:00'
  WHEN 5 THEN substr({s},1,4) || substr({s},6,2) || substr({s},9,2)
  WHEN 6 THEN substr({s},9,2) || '-' || {mon} || '-' || substr({s},3,2)
  ELSE CAST(43556 + ({k}) % 1800 AS STRING) END"""


def _audit(key: str, cust: str, ts: str, table: str) -> str:
    org = f"CAST(CASE WHEN {cust} % 89 = 5 THEN 8 ELSE {cust} % 6 END AS STRING)"  # submitter 8 has no project
    return (f"'ORG0' || {org} || '_202401.zip' AS SubmittedZipFile, "
            f"'MI_ORG0' || {org} || '_{table}.csv' AS SubmittedFile, "
            f"'user' || CAST({cust} % 3 AS STRING) || '@example.org' AS UserEmail, "
            f"{key} % 500 AS TransactionId, CAST(CAST({ts} AS DATE) + INTERVAL 24 YEAR AS DATE) AS ReceivedDate")


_AUDIT = "SubmittedZipFile, SubmittedFile, UserEmail, TransactionId, CSURowNumber, ReceivedDate"
_LINE = "l_orderkey * 8 + l_linenumber"
_LINES = "{lineitem} JOIN {orders} ON l_orderkey = o_orderkey"
# one row per order line, for the tables whose key must be unique
_UNIQUE_LINES = ("(SELECT l_orderkey, l_linenumber, o_custkey, MIN(l_shipdate) AS l_shipdate FROM " + _LINES
                 + " GROUP BY l_orderkey, l_linenumber, o_custkey) u")

VIEWS: dict[str, str] = {}

VIEWS["fx_demographics"] = f"""
SELECT {_person('c_custkey')} AS ParticipantID, {_audit('c_custkey', 'c_custkey', "DATE '1999-01-01'", 'DEMOGRAPHICS')},
 c_custkey AS CSURowNumber,
 CASE WHEN c_custkey % 31 = 0 THEN 'NULL' WHEN c_custkey % 37 = 0 THEN 'IA2' WHEN c_custkey % 7 = 0 THEN CAST(45 + c_custkey % 40 AS STRING) || 'yrs'
   ELSE CAST(45 + c_custkey % 40 AS STRING) END AS Age,
 CASE c_custkey % 5 WHEN 0 THEN 'F' WHEN 1 THEN ' male' WHEN 2 THEN 'FEMALE' WHEN 3 THEN 'm' ELSE 'X' END AS Sex,
 CAST(c_nationkey AS STRING) AS LSOA, CASE WHEN c_custkey % 83 <> 3 THEN c_mktsegment END AS Ethnicity,
 CASE c_custkey % 6 WHEN 0 THEN 'Single' WHEN 1 THEN 'Divorced' WHEN 2 THEN 'Widow(er)' WHEN 3 THEN 'Separated' WHEN 4 THEN 'unlisted' END AS Marital_Status,
 CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 10 < 6 THEN 'English' WHEN c_custkey % 10 < 8 THEN 'Urdu' WHEN c_custkey % 10 = 8 THEN 'Polish' ELSE 'Bengali' END AS Language,
 CAST(c_nationkey % 7 AS STRING) AS CCG_Code
FROM {{customer}}"""

VIEWS["fx_invite"] = f"""
SELECT ParticipantID, {_AUDIT},
 {_dirty('s', 'k')} AS First_Letter_Date,
 CASE WHEN k % 3 = 0 THEN {_dirty('s2', 'k+1')} END AS Second_Letter_Date,
 CASE WHEN k % 5 = 0 THEN {_dirty('s3', 'k+2')} END AS Follow_Up_Call_Date,
 CASE WHEN k % 4 = 1 THEN {_dirty('s4', 'k+5')} END AS Contact_Date, Invite_Outcome
FROM (SELECT o_orderkey AS k, {_person('o_custkey')} AS ParticipantID, {_audit('o_orderkey', 'o_custkey', 'o_orderdate', 'INVITES')},
 o_orderkey AS CSURowNumber, {_day('o_orderdate')} AS s, {_day('o_orderdate', '30 + o_orderkey % 60')} AS s2,
 {_day('o_orderdate', '90 + o_orderkey % 30')} AS s3, {_day('o_orderdate', '5')} AS s4,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'Participant accepted invitation' WHEN '2-HIGH' THEN 'accepted'
   WHEN '3-MEDIUM' THEN 'Participant declined invitation'
   WHEN '5-LOW' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'Participant removed from GP list' ELSE 'Participant did not respond to invitation' END END AS Invite_Outcome
FROM {{orders}}) t"""

VIEWS["fx_check"] = f"""
SELECT ParticipantID, {_AUDIT},
 CASE WHEN k % 43 = 0 THEN att ELSE {_dirty('s', 'k')} END AS LHC_Date,
 CASE WHEN k % 43 = 0 THEN {_dirty('s', 'k')} ELSE att END AS LHC_Attendance, LHC_Delivery_Mode,
 CASE WHEN k % 14 = 0 THEN {_dirty('s0', 'k+3')} WHEN k % 22 = 0 THEN 'N/A' END AS Date_Stopped_Smoking,
 CASE WHEN k % 10 = 0 THEN CAST(k % 30 AS DOUBLE) END AS Total_Quit_Period
FROM (SELECT o_orderkey AS k, {_person('o_custkey')} AS ParticipantID, {_audit('o_orderkey', 'o_custkey', 'o_orderdate', 'CHECKS')},
 o_orderkey AS CSURowNumber, {_day('o_orderdate', '14 + o_orderkey % 90')} AS s, {_day('o_orderdate', '-400')} AS s0,
 CASE o_orderstatus WHEN 'F' THEN 'Attended' WHEN 'O' THEN 'Did not attend' ELSE 'Participant attended but did not complete LHC' END AS att,
 CASE o_orderkey % 8 WHEN 0 THEN 'F2F' WHEN 2 THEN 'Phone' WHEN 4 THEN 'in-person' END AS LHC_Delivery_Mode
FROM {{orders}}) t"""

VIEWS["fx_measurement"] = f"""
SELECT {_person('c_custkey')} AS ParticipantID, {_audit('c_custkey', 'c_custkey', "DATE '1999-01-01'", 'MEASUREMENTS')},
 c_custkey AS CSURowNumber,
 CASE WHEN c_custkey % 29 = 0 THEN 'NULL' WHEN c_custkey % 11 = 0 THEN '0..' || CAST(10 + c_custkey % 80 AS STRING)
   WHEN c_custkey % 23 = 0 THEN '01:50' ELSE CAST(c_custkey % 4 AS STRING) || '.' || CAST(10 + c_custkey % 80 AS STRING) END AS PLCOm2012,
 CASE WHEN c_custkey % 13 = 0 THEN '>3.56' WHEN c_custkey % 17 = 0 THEN '?0.89 ' WHEN c_custkey % 19 = 0 THEN '1.56;'
   WHEN c_custkey % 41 = 0 THEN '2..07' ELSE CAST(c_custkey % 5 AS STRING) || '.5' END AS LLPv2_Risk,
 CASE c_custkey % 9 WHEN 0 THEN 'Unable to lie down' WHEN 1 THEN 'none' WHEN 2 THEN 'NULL' WHEN 3 THEN 'something else' WHEN 4 THEN '     ' END AS Exclusion_Criteria,
 CASE c_custkey % 8 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' WHEN 2 THEN 'Not current smoker' WHEN 3 THEN ' N ' END AS Smoking_Cessation_Offered
FROM {{customer}}"""

VIEWS["fx_scan"] = f"""
SELECT ParticipantID, {_AUDIT},
 CASE WHEN k % 41 = 0 THEN 'LDCT performed' ELSE {_dirty('s', 'k')} END AS LDCT_Date,
 CASE WHEN k % 41 = 0 THEN {_dirty('s', 'k')} ELSE outcome END AS LDCT_Outcome,
 {_dirty('s2', 'k+3')} AS LDCT_ReportDate1,
 CASE WHEN k % 5 = 0 THEN {_dirty('s3', 'k+1')} END AS Date_Referral_Lung_Cancer,
 CASE WHEN k % 37 = 0 THEN {_dirty('s3', 'k+2')} END AS Date_ReferralOtherCancer,
 Other_Incidental_Findings, Pulmonary_Incidental_Findings, Emphysema_Extent
FROM (SELECT {_LINE} AS k, {_person('o_custkey')} AS ParticipantID, {_audit('o_orderkey', 'o_custkey', 'o_orderdate', 'LDCT')},
 {_LINE} AS CSURowNumber, {_day('l_shipdate')} AS s, {_day('l_shipdate', '7')} AS s2, {_day('l_shipdate', '20')} AS s3,
 CASE l_returnflag WHEN 'R' THEN 'LDCT did not attend' WHEN 'A' THEN 'LDCT_PERFORMED' ELSE 'performed' END AS outcome,
 CASE l_orderkey % 16 WHEN 0 THEN 'Emphysema-Consolidaton' WHEN 1 THEN 'renal lesion. Osteoporosis' WHEN 2 THEN 'thyroid lesionCoronary calcification'
  WHEN 3 THEN 'Other' WHEN 4 THEN 'Tuberculosis - Mediastinal mas' WHEN 5 THEN 'aortic valve calcificaton. Thoracic aortic aneurism'
  WHEN 6 THEN 'Pleural effusions/thickening-Suspicious breast lesions' WHEN 7 THEN 'Liver or splenic lesionAdrenal lesions'
  WHEN 8 THEN 'Abdominal aortic aneurysm' WHEN 9 THEN 'Bone abnormality. Fractures with no trauma history' WHEN 10 THEN 'other cancer'
  WHEN 11 THEN '' END AS Other_Incidental_Findings,
 CASE l_orderkey % 7 WHEN 0 THEN 'Bronchiectasis - ILA' WHEN 1 THEN 'respiratory bronchioliti' WHEN 2 THEN 'Interstitial lung abnormalities (ILAs)' END AS Pulmonary_Incidental_Findings,
 CASE l_linenumber WHEN 1 THEN 'Moderate' WHEN 2 THEN 'severe emphysema' WHEN 3 THEN 'mild' END AS Emphysema_Extent
FROM {_LINES}) t"""

VIEWS["fx_smoking"] = f"""
SELECT ParticipantID, {_AUDIT},
 CASE WHEN k % 7 <> 0 THEN {_dirty('s', 'k')} END AS Date_Offered_Smoking_Cessation,
 CASE WHEN k % 2 = 0 THEN {_dirty('s2', 'k+1')} END AS Date_Started_Smoking_Cessation,
 CASE WHEN k % 4 = 0 THEN {_dirty('s3', 'k+2')} END AS Date_Ended_Smoking_Cessation,
 CASE k % 5 WHEN 0 THEN 'y' WHEN 1 THEN 'NO' WHEN 2 THEN ' yes' WHEN 3 THEN 'unsure' END AS Smoking_Cessation_Completed_Successfully
FROM (SELECT o_orderkey AS k, {_person('o_custkey')} AS ParticipantID, {_audit('o_orderkey', 'o_custkey', 'o_orderdate', 'SMOKING')},
 o_orderkey AS CSURowNumber, {_day('o_orderdate', '20')} AS s, {_day('o_orderdate', '40')} AS s2, {_day('o_orderdate', '100')} AS s3
FROM {{orders}}) t"""

VIEWS["fx_diagnostics"] = f"""
SELECT ParticipantID, {_AUDIT},
 {_dirty('s', 'k')} AS Full_Dose_CT_Date,
 CASE WHEN k % 2 = 0 THEN {_dirty('s2', 'k+1')} END AS PET_CT_Date,
 CASE WHEN k % 3 = 0 THEN {_dirty('s2', 'k+2')} END AS Bronchoscopy_Date,
 CASE WHEN k % 4 = 0 THEN {_dirty('s3', 'k+3')} END AS Pathology_Report_Date,
 CASE WHEN k % 3 = 1 THEN {_dirty('s3', 'k+4')} END AS Cancer_Diagnosis_Date
FROM (SELECT {_LINE} AS k, {_person('o_custkey')} AS ParticipantID, {_audit('o_orderkey', 'o_custkey', 'o_orderdate', 'DIAGNOSTICS')},
 {_LINE} AS CSURowNumber, {_day('l_shipdate', '12')} AS s, {_day('l_shipdate', '20')} AS s2, {_day('l_shipdate', '30')} AS s3
FROM {_LINES}) t"""

VIEWS["fx_history"] = f"""
SELECT ParticipantID, {_AUDIT}, {_dirty('s', 'k')} AS Cancer_Date
FROM (SELECT o_orderkey AS k, {_person('o_custkey')} AS ParticipantID, {_audit('o_orderkey', 'o_custkey', 'o_orderdate', 'HISTORY')},
 o_orderkey AS CSURowNumber, {_day('o_orderdate', '-900')} AS s
FROM {{orders}}) t"""

_CODES = """CASE k % 5 WHEN 0 THEN 'C34' WHEN 1 THEN 'C50' WHEN 2 THEN 'C34' WHEN 3 THEN 'D09' ELSE 'C76' END"""
_STAGES = """CASE k % 6 WHEN 0 THEN '1A' WHEN 1 THEN '2' WHEN 2 THEN '3B' WHEN 3 THEN '4' WHEN 4 THEN '?' ELSE 'U' END"""

VIEWS["fx_registry"] = f"""
SELECT 'T' || CAST(k AS STRING) AS TUMOUR_ID, ParticipantID, diag AS DIAGNOSISDATEBEST, {_CODES} AS SITE_ICD10_3CHAR, {_STAGES} AS STAGE_BEST,
 CAST(k % 4 AS INT) AS GENDER, substr('ABC0DEGHJKLMNPRSZX', CAST(1 + k % 18 AS INT), 1) AS ETHNICITY, CAST(40 + k % 50 AS INT) AS AGE,
 CASE k % 11 WHEN 0 THEN 'Diagnosed in 2013 is 2015 quintile otherwise 2019 quintile' WHEN 1 THEN '1 - most deprived' WHEN 10 THEN '10 - least deprived' ELSE CAST(k % 11 AS STRING) END AS IMD_DECILE,
 CASE k % 5 WHEN 0 THEN '1 - most deprived' WHEN 4 THEN '5 - least deprived' ELSE CAST(1 + k % 5 AS STRING) END AS IMD_QUINTILE,
 'TR' || CAST(c % 4 AS STRING) AS DIAG_TRUST, 'Alliance ' || CAST(c % 5 AS STRING) AS CANALLIANCE_NAME, 'Route ' || CAST(k % 3 AS STRING) AS FINAL_ROUTE,
 CASE WHEN k % 4 = 0 THEN 1 ELSE 2 END AS DatasetId
FROM (SELECT {_LINE} AS k, o_custkey AS c, {_person('o_custkey')} AS ParticipantID,
 CAST(CAST(CAST(l_shipdate AS DATE) + INTERVAL 24 YEAR AS DATE) + CAST(({_LINE}) % 120 - CASE WHEN l_shipdate < TIMESTAMP '1998-07-01 00:00:00' THEN 0 ELSE 2000 END AS INT) AS DATE) AS diag
FROM {_UNIQUE_LINES}) t"""

VIEWS["fx_rapid"] = f"""
SELECT 'R' || CAST(k AS STRING) AS TUMOUR_AVP_ID, ParticipantID, diag AS DIAGNOSISDATE, {_CODES} AS TUMOUR_SITE, {_STAGES} AS STAGE,
 CAST(k % 4 AS INT) AS GENDER, substr('ABC0DEGHJKLMNPRSZX', CAST(1 + k % 18 AS INT), 1) AS ETHNICCATEGORY, CAST(40 + k % 50 AS INT) AS PatientAge,
 CASE k % 5 WHEN 0 THEN '1 - most deprived' WHEN 4 THEN '5 - least deprived' ELSE CAST(1 + k % 5 AS STRING) END AS IMD_QUINTILE,
 'TR' || CAST(c % 4 AS STRING) AS TRUST_CODE, 'Alliance ' || CAST(c % 5 AS STRING) AS CANALLIANCE_NAME, 'Route ' || CAST(k % 3 AS STRING) AS FINAL_ROUTE,
 CASE WHEN k % 3 = 0 THEN 1 ELSE 2 END AS DatasetId
FROM (SELECT {_LINE} AS k, o_custkey AS c, {_person('o_custkey')} AS ParticipantID,
 CAST(CAST(CAST(l_shipdate AS DATE) + INTERVAL 24 YEAR AS DATE) + CAST(({_LINE}) % 97 AS INT) AS DATE) AS diag
FROM {_UNIQUE_LINES}) t"""

VIEWS["fx_pathway"] = f"""
SELECT ParticipantID, EVENT_DATE, EVENT_TYPE, TUMOUR_ID, DatasetId
FROM (SELECT {_person('o_custkey')} AS ParticipantID,
 CAST(CAST(CAST(l_shipdate AS DATE) + INTERVAL 24 YEAR AS DATE) + CAST(({_LINE}) % 120 + ({_LINE}) % 20 AS INT) AS DATE) AS EVENT_DATE,
 CASE ({_LINE}) % 3 WHEN 0 THEN 6 WHEN 1 THEN 100 ELSE 20 END AS EVENT_TYPE,
 'T' || CAST({_LINE} AS STRING) AS TUMOUR_ID, CASE WHEN ({_LINE}) % 5 = 0 THEN 1 ELSE 2 END AS DatasetId
FROM {_UNIQUE_LINES}) t"""

VIEWS["fx_project_names"] = """
SELECT 'ORG0' || CAST(n_nationkey % 6 AS STRING) AS org_code, 'Project ' || CAST(n_nationkey % 6 AS STRING) AS project_name_place,
 CASE WHEN n_nationkey IN (5, 11) THEN 1 ELSE 0 END AS split_by_ccg,
 CASE n_nationkey WHEN 5 THEN '5' WHEN 11 THEN '6' END AS CCG_Code,
 CASE n_nationkey WHEN 5 THEN 'Area 5' WHEN 11 THEN 'Area 6' END AS project_name_ccg
FROM {nation}"""

VIEWS["fx_projects"] = """
SELECT CASE WHEN n_nationkey < 6 THEN 'ORG0' ELSE 'CCG0' END || CAST(CASE WHEN n_nationkey < 6 THEN n_nationkey ELSE n_nationkey - 1 END AS STRING) AS project_code,
 CASE WHEN n_nationkey < 6 THEN 'Project ' || CAST(n_nationkey AS STRING) ELSE 'Area ' || CAST(n_nationkey - 1 AS STRING) END AS project,
 CASE n_nationkey % 3 WHEN 0 THEN 'Original' WHEN 1 THEN 'Onboarded' ELSE 'Phase 3' END AS phase,
 CAST(DATE '2019-04-01' + CAST(31 * n_nationkey AS INT) AS DATE) AS start_date, CAST(1000 * (n_nationkey + 1) AS INT) AS eligible_population,
 'E' || CAST(n_nationkey % 4 AS STRING) AS CACode, 'Alliance ' || CAST(n_nationkey % 4 AS STRING) AS CAName,
 CASE n_nationkey % 3 WHEN 0 THEN 'Opt-in' WHEN 1 THEN 'Opt-out' ELSE 'Combined' END AS invite_mode,
 CASE n_nationkey % 2 WHEN 0 THEN 'Virtual' ELSE 'Face-to-face' END AS lhc_delivery,
 CASE n_nationkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END AS triage_before_risk_assessment,
 CASE n_nationkey % 2 WHEN 0 THEN 'In-house' ELSE 'Outsourced' END AS admin
FROM {nation}"""

VIEWS["fx_areas"] = """
SELECT CAST(n_nationkey AS STRING) AS LSOA_CODE, n_name AS LSOA_NAME, 'LA' || CAST(n_regionkey AS STRING) AS LA_CODE, r_name AS LA_NAME,
 CAST(n_nationkey * 10 AS INT) AS RANK, CASE WHEN n_nationkey <> 24 THEN CAST(n_nationkey % 10 + 1 AS INT) END AS Decile,
 CASE n_nationkey % 5 WHEN 0 THEN 'A1' WHEN 1 THEN 'C2' WHEN 2 THEN 'D1' WHEN 3 THEN 'F2' ELSE 'Z9' END AS RUC11CD
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""

VIEWS["fx_ethnicity"] = """
SELECT DISTINCT c_mktsegment AS Ethnicity, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'White' WHEN 'BUILDING' THEN 'Asian or Asian British'
 WHEN 'FURNITURE' THEN 'Mixed' ELSE 'Other Ethnic Group' END AS EthnicGroup
FROM {customer} WHERE c_mktsegment <> 'HOUSEHOLD'"""

VIEWS["fx_excluded_transactions"] = """
SELECT DISTINCT o_orderkey % 500 AS TransactionId, CASE o_orderkey % 500 WHEN 13 THEN 'invite' WHEN 33 THEN 'scan' WHEN 40 THEN 'check' WHEN 55 THEN 'demographics' END AS table_name
FROM {orders} WHERE o_orderkey % 500 IN (7, 13, 21, 33, 40, 55)"""

VIEWS["fx_excluded_people"] = f"""
SELECT {_person('c_custkey')} AS ParticipantID, CASE WHEN c_custkey % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS active
FROM {{customer}} WHERE c_custkey % 53 = 0"""

VIEWS["fx_stage_submissions"] = """
SELECT 'Project ' || CAST(o_custkey % 6 AS STRING) AS Place, substr(CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 YEAR AS DATE) AS STRING), 3, 2) ||
  substr(CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 YEAR AS DATE) AS STRING), 6, 2) AS Date,
 'Stage group ' || CAST(o_orderkey % 6 AS STRING) AS Metric,
 CASE o_orderkey % 6 WHEN 0 THEN '6a' WHEN 1 THEN '6b' WHEN 2 THEN '6c' WHEN 3 THEN '6d' WHEN 4 THEN '6e' ELSE '6f' END AS MetricID,
 CASE WHEN MIN(o_orderkey) % 9 = 0 THEN 'NA' ELSE CAST(COUNT(*) AS STRING) END AS Number
FROM {orders} GROUP BY o_custkey % 6, o_orderkey % 6, 
 substr(CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 YEAR AS DATE) AS STRING), 3, 2) || substr(CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 YEAR AS DATE) AS STRING), 6, 2)"""

VIEWS["fx_metric_rows"] = """
SELECT CASE WHEN c % 7 <> 6 THEN 'Project ' || CAST(c % 7 AS STRING) END AS project, metric_id, month, 'Metric ' || metric_id AS metric_name,
 CASE WHEN MIN(k) % 31 = 0 THEN NULL ELSE CAST(COUNT(DISTINCT c) + SUM(k % 7) AS DOUBLE) END AS numerator
FROM (SELECT o_custkey AS c, o_orderkey AS k, CAST(date_trunc('month', CAST(o_orderdate AS DATE) + INTERVAL 24 YEAR) AS DATE) AS month,
 CASE o_orderkey % 24 WHEN 0 THEN '1a' WHEN 1 THEN '1c' WHEN 2 THEN '2' WHEN 3 THEN '3a' WHEN 4 THEN '3b' WHEN 5 THEN '3c' WHEN 6 THEN '3d'
  WHEN 7 THEN '4' WHEN 8 THEN '4b' WHEN 9 THEN '5a' WHEN 10 THEN '5b' WHEN 11 THEN '5d' WHEN 12 THEN '5e' WHEN 13 THEN '6a' WHEN 14 THEN '6b'
  WHEN 15 THEN '6c' WHEN 16 THEN '6d' WHEN 17 THEN '6e' WHEN 18 THEN '7' WHEN 19 THEN '8a' WHEN 20 THEN '8b' WHEN 21 THEN '10'
  WHEN 22 THEN '11' ELSE '14a' END AS metric_id
FROM {orders}) t GROUP BY c % 7, metric_id, month"""

VIEWS["fx_adjustments"] = """
SELECT 'Project ' || CAST(o_custkey % 6 AS STRING) AS project, CAST(CAST(o_orderdate AS DATE) + INTERVAL 24 YEAR AS DATE) AS month,
 CASE o_orderkey % 3 WHEN 0 THEN '1a' WHEN 1 THEN '2' ELSE '5a' END AS metric_id, CAST(MAX(o_orderkey) AS DOUBLE) AS numerator,
 CASE WHEN MAX(o_orderkey) % 4 = 0 THEN 'FALSE' ELSE 'TRUE' END AS active,
 CASE WHEN MAX(o_orderkey) % 5 = 0 THEN '2023-01-01' END AS date_removed
FROM {orders} GROUP BY 1, 2, 3"""

VIEWS["fx_files"] = """
SELECT page_id, CASE page_id % 11 WHEN 0 THEN 'Working.xlsx' WHEN 1 THEN '~' || code || '/' || code || '_Mar_2022.xlsx'
  WHEN 2 THEN 'archive/' || code || '_Mar_2022.xlsx' WHEN 3 THEN code || '.xlsx'
  ELSE 'Place ' || code || '/' || code || '_' || substr('JanFebMarAprMayJunJulAugSepOctNovDec', CAST(1 + 3 * (page_id % 12) AS INT), 3) || '_' || CAST(2017 + page_id % 8 AS STRING) || '.xlsx' END AS folder_file
FROM (SELECT page_id, CASE WHEN url LIKE '%/en/%' THEN 'ORG0' || CAST(page_id % 6 AS STRING) ELSE 'XX9' END AS code FROM {pages}) t"""

GIVEN = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
         "embeddings", "pages", "benchmark", "labels", "conversations"]


def view_sql(name: str) -> str:
    """View text for an engine that has the given tables under their own names."""
    return re.sub(r"\{(\w+)\}", r"\1", VIEWS[name])


class Views(Mapping):
    """Cohort views by their short name, made when asked for."""

    def __init__(self, source: "Source", names):
        self._source, self._names = source, list(names)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        return self._source.fx(f"fx_{name}")

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


class Source:
    """The given tables and the cohort views of one directory.

    The views' expressions are long and their records wide: see io.split_long_methods and io.small_tasks. Five views are made of
    order lines with their orders: ``shared`` joins these once, by order, and writes them for all five.
    """

    def __init__(self, spark: SparkSession, path: str, shared: bool = False):
        io.split_long_methods(spark)
        io.small_tasks(spark)
        self.spark, self.path, self.shared = spark, path, shared
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._tables[name]

    @cached_property
    def lines(self) -> DataFrame:
        orders = self.table("orders").select("o_orderkey", "o_custkey", "o_orderdate").hint("merge")
        lines = self.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
        both = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
        return io.staged(self.spark)(both, "lines", "l_orderkey", placed=True).withColumn("o_orderkey", F.col("l_orderkey"))

    def fx(self, name: str) -> DataFrame:
        text = VIEWS[name].replace(_LINES, "{lines}") if self.shared else VIEWS[name]
        needed = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{t: self.lines if t == "lines" else self.table(t) for t in needed})
