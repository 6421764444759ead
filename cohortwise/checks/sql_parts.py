"""Shared parts of the SQL twins: plain DuckDB SQL, written apart from the Spark code."""

from __future__ import annotations

from cohortwise.sources.fixtures import VIEWS, view_sql

PARTS: dict[str, str] = {name: view_sql(name) for name in VIEWS}

FORMATS = "['%d/%m/%Y','%d/%m/%Y %H:%M','%b %d %Y %H:%M','%d-%m-%y','%Y-%m-%d %H:%M:%S','%Y%m%d','%d-%b-%y']"


def dt(c: str) -> str:
    return (f"(CASE WHEN length({c}) = 5 THEN CAST(DATE '1899-12-30' + TRY_CAST({c} AS INTEGER) AS DATE) "
            f"ELSE CAST(try_strptime({c}, {FORMATS}) AS DATE) END)")


def mon(c: str) -> str:
    return f"CAST(date_trunc('month', {c}) AS DATE)"


def complete_months(a: str, b: str) -> str:
    span = f"((year({b}) - year({a})) * 12 + month({b}) - month({a}))"
    return (f"(CASE WHEN {span} > 0 AND day({b}) < day({a}) THEN {span} - 1 "
            f"WHEN {span} < 0 AND day({b}) > day({a}) THEN {span} + 1 ELSE {span} END)")


def current(view: str, keys: str, ties: str = "") -> str:
    ties = "".join(f", {t} ASC NULLS FIRST" for t in ties.split())
    return f"""SELECT * EXCLUDE (rn),
  substr(SubmittedZipFile, 1, 5) AS org_code,
  CASE WHEN length(ParticipantID) < 60 THEN 'Invalid' ELSE 'Valid' END AS person_validity,
  CASE WHEN TransactionId IN (250, 251) THEN 'Invalid'
       WHEN substr(SubmittedZipFile, 1, 5) = 'ORG04' AND TransactionId < max(TransactionId) OVER (PARTITION BY substr(SubmittedZipFile, 1, 5)) THEN 'Invalid'
       ELSE 'Valid' END AS transaction_validity
FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ReceivedDate DESC, CSURowNumber DESC{ties}) AS rn
  FROM {view}
  WHERE TransactionId NOT IN (SELECT TransactionId FROM fx_excluded_transactions WHERE table_name IS NULL OR table_name = '{view.removeprefix("fx_")}')
    AND ParticipantID NOT IN (SELECT ParticipantID FROM fx_excluded_people WHERE active = 'TRUE')) WHERE rn = 1"""


PARTS["cur_demographics"] = current("fx_demographics", "ParticipantID")
PARTS["cur_invite"] = current("fx_invite", "ParticipantID")
PARTS["cur_check"] = current("fx_check", "ParticipantID, LHC_Date")
PARTS["cur_measurement"] = current("fx_measurement", "ParticipantID")
PARTS["cur_scan"] = current("fx_scan", "ParticipantID, LDCT_Date",
                            "Date_ReferralOtherCancer Date_Referral_Lung_Cancer Emphysema_Extent LDCT_Outcome LDCT_ReportDate1")
PARTS["cur_diagnostics"] = current("fx_diagnostics", "ParticipantID, Full_Dose_CT_Date",
                                   "Bronchoscopy_Date Cancer_Diagnosis_Date PET_CT_Date Pathology_Report_Date")
PARTS["cur_history"] = current("fx_history", "ParticipantID")
PARTS["cur_smoking"] = current("fx_smoking", "ParticipantID")

NUM = r"regexp_full_match({0}, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')"


def num(c: str) -> str:
    return f"(CASE WHEN {NUM.format(c)} THEN TRY_CAST(trim({c}) AS DOUBLE) END)"


AGE = num("nullif(nullif(regexp_replace(Age, 'yrs', ''), 'NULL'), 'IA2')")
SEX = "CASE WHEN upper(trim(Sex)) IN ('F','FEMAL','FEMALE') THEN 'Female' WHEN upper(trim(Sex)) IN ('M','MALE') THEN 'Male' ELSE 'Not known' END"


def bands(a: str, pairs: list[tuple[int, str]], last: str) -> str:
    return (f"CASE WHEN {a} IS NULL THEN 'Not known' " + " ".join(f"WHEN {a} <= {u} THEN '{l}'" for u, l in pairs)
            + f" ELSE '{last}' END")


BAND = [(-1, "Age below zero"), (49, "0-49"), (59, "50-59"), (69, "60-69"), (79, "70-79")]
BAND5 = [(-1, "Age below zero"), (49, "0-49"), (54, "50-54"), (59, "55-59"), (64, "60-64"), (69, "65-69"), (74, "70-74"), (79, "75-79")]
BANDE = [(-1, "Age below zero"), (54, "Other"), (64, "55-64"), (74, "65-74"), (75, "75")]

PARTS["cl_demographics"] = f"""SELECT d.*, a.LSOA_NAME AS lsoa_name, a.Decile AS imd_decile, a.RUC11CD AS rurality_code, {SEX} AS sex_c,
  {AGE} AS age_n, CASE WHEN {AGE} BETWEEN 55 AND 74 THEN 'Valid' ELSE 'Invalid' END AS age_validity,
  {bands(AGE, BAND, '80+')} AS age_band, {bands(AGE, BAND5, '80+')} AS age_band_five, {bands(AGE, BANDE, 'Other')} AS age_band_eval,
  CASE WHEN Marital_Status IN ('Single','Married or civil partner','Divorced','Separated','Widow(er)','Prefer not to say','Not known') THEN Marital_Status ELSE 'Not known' END AS marital,
  CASE WHEN e.EthnicGroup IN ('Asian or Asian British','Black or Black British','Mixed','Not stated','Other Ethnic Group','White') THEN e.EthnicGroup ELSE 'Not known' END AS ethnic_group,
  CASE WHEN a.RUC11CD IN ('A1','B1','C1','C2') THEN 'Urban' WHEN a.RUC11CD IN ('D1','D2','E1','E2','F1','F2') THEN 'Rural' WHEN a.RUC11CD IS NOT NULL THEN 'NOT CODED' END AS rurality
FROM cur_demographics d LEFT JOIN fx_areas a ON d.LSOA = a.LSOA_CODE LEFT JOIN fx_ethnicity e ON d.Ethnicity = e.Ethnicity"""

PARTS["p_invite"] = f"""SELECT *, {dt('First_Letter_Date')} AS first_letter_d, {dt('Second_Letter_Date')} AS second_letter_d,
  {dt('Follow_Up_Call_Date')} AS call_d, {dt('Contact_Date')} AS contact_d FROM cur_invite"""
PARTS["cl_invite"] = f"""SELECT *, {mon('first_letter_d')} AS first_letter_m, {mon('second_letter_d')} AS second_letter_m, {mon('call_d')} AS call_m,
  {mon('outcome_d')} AS outcome_m FROM (SELECT *, greatest(contact_d, call_d, second_letter_d, first_letter_d) AS outcome_d,
  CASE WHEN upper(Invite_Outcome) IN ('PARTICIPANT DOES NOT MEET AGE CRITERIAA','PARTICIPANT DOES NOT MEET AGE CRITERIA','PARTICIPANT DOES NOT MEET SMOKING CRITERIA',
    'PARTICIPANT REMOVED FROM GP LIST','PARTICIPANT_REMOVED_FROM_GP_LIST') THEN 'Ineligible' ELSE 'Eligible' END AS eligible,
  CASE WHEN upper(Invite_Outcome) IN ('ACCEPTED','PARTICIPANT ACCEPTED INVITATION','PARTICIPANT_ACCEPTED_INVITATION') THEN 'Accepted' END AS accepted
  FROM p_invite)"""

PARTS["cl_check"] = f"""SELECT *, {mon('check_d')} AS check_m,
  CASE WHEN upper(attendance_t) IN ('ATTENDED','PARTICIPANT ATTENDED LHC','PATICIPANT_ATTEND_LHC','SCREENING - HEALTH CHECK (XM1XS)','FINISHED') THEN 'Attended'
       WHEN upper(attendance_t) = 'PARTICIPANT ATTENDED BUT DID NOT COMPLETE LHC' THEN 'Partially attended'
       WHEN upper(attendance_t) IN ('DID NOT ATTEND','DIDNOTATTEND','PARTICIPANT DID NOT ATTEND LHC','PATICIPANT_DID_NOT_ATTEND_LHC') THEN 'DNA'
       WHEN attendance_t IS NULL THEN 'NULL response' ELSE 'NOT CODED' END AS attendance_c,
  CASE WHEN upper(LHC_Delivery_Mode) IN ('F2F','FACE TO FACE','IN-PERSON') THEN 'F2F' WHEN upper(LHC_Delivery_Mode) IN ('PHONE','TELEPHONE','VIRTUAL') THEN 'Virtual'
       WHEN LHC_Delivery_Mode IS NULL THEN 'NULL response' ELSE 'NOT CODED' END AS delivery_c
FROM (SELECT *, coalesce({dt('LHC_Date')}, {dt('LHC_Attendance')}) AS check_d,
  CASE WHEN {dt('LHC_Attendance')} IS NOT NULL THEN coalesce(LHC_Date, LHC_Attendance) ELSE LHC_Attendance END AS attendance_t,
  {dt('Date_Stopped_Smoking')} AS stopped_d FROM cur_check)"""

PLCO = num("regexp_replace(nullif(PLCOm2012, 'NULL'), '\\.{2}|:', '.')")
LLP = num("trim(regexp_replace(regexp_replace(regexp_replace(nullif(LLPv2_Risk, 'NULL'), '\\.{2}', '.'), '>', ''), '\\?|;', ''))")
PARTS["cl_measurement"] = f"""SELECT *, CASE WHEN plco_n >= 1.51 THEN 'High risk' WHEN plco_n IS NOT NULL THEN 'Low risk' END AS plco_r,
  CASE WHEN llp_n >= 2.5 THEN 'High risk' WHEN llp_n IS NOT NULL THEN 'Low risk' END AS llp_r,
  CASE reason WHEN 'UNABLE TO LIE DOWN' THEN 'Unable to lie flat' WHEN 'UNABLE TO LIE FLAT' THEN 'Unable to lie flat' WHEN 'WEIGHT >200KG' THEN 'Weight >200Kg'
    WHEN 'PREVIOUS CT <12 MONTHS AGO' THEN 'Previous CT <12 months ago' WHEN 'PARTICIPANT DECLINED' THEN 'Participant declined'
    WHEN 'NOT PHYSICALLY FIT' THEN 'Not physically fit' ELSE CASE WHEN reason IS NOT NULL THEN 'Other' END END AS exclusion_c
FROM (SELECT *, {PLCO} AS plco_n, {LLP} AS llp_n,
  CASE WHEN upper(Exclusion_Criteria) NOT IN ('     ','NONE','NULL') THEN upper(Exclusion_Criteria) END AS reason FROM cur_measurement)"""

OUTCOME = """CASE WHEN {0} IS NULL THEN NULL
  WHEN upper({0}) IN ('LD CT SCAN PERFORMED','LDCT _PERFORMED','LDCT PERFORMED','LDCT PERFROMED','LDCT_PERFORMED','PERFORMED') THEN 'LDCT performed'
  WHEN upper({0}) = 'LDCT DID NOT ATTEND' THEN 'LDCT did not attend' WHEN upper({0}) = 'LDCT NOT COMPLETED' THEN 'LDCT not completed (no reason recorded)'
  WHEN upper({0}) LIKE 'LDCT NOT COMPLETED%(TECHNICAL/OPERATIONA%' THEN 'LDCT not completed (technical / operational)'
  WHEN upper({0}) = 'LDCT NOT COMPLETED (PARTICIPANT UNWELL)' THEN 'LDCT not completed (participant unwell)'
  WHEN upper({0}) LIKE 'LDCT NOT COMPLETED%(PARTICIPANT ABANDONE%' THEN 'LDCT not completed (participant abandoned)' ELSE 'Other' END"""
CATEGORY = """CASE WHEN {0} IS NULL THEN NULL WHEN {0} <= -1 THEN 'Not classified' WHEN {0} <= 1 THEN 'Initial scan' WHEN {0} <= 61 THEN 'Not classified'
  WHEN {0} <= 152 THEN '3 month follow-up scan' WHEN {0} <= 335 THEN 'Not classified' WHEN {0} <= 456 THEN '12 month follow-up scan' WHEN {0} <= 669 THEN 'Not classified'
  WHEN {0} <= 791 THEN '24 month follow-up scan' WHEN {0} <= 1400 THEN '2-year+ nodule surveillance' WHEN {0} <= 1521 THEN '48 month follow-up scan'
  ELSE '2-year+ nodule surveillance' END"""

PARTS["p_scan"] = f"""SELECT *, coalesce({dt('LDCT_Date')}, {dt('LDCT_Outcome')}) AS raw_d, {dt('LDCT_ReportDate1')} AS report_d,
  {dt('Date_Referral_Lung_Cancer')} AS lung_d, {dt('Date_ReferralOtherCancer')} AS other_d,
  {OUTCOME.format("coalesce(CASE WHEN LDCT_Date = 'LDCT performed' THEN LDCT_Date END, LDCT_Outcome)")} AS outcome_c FROM cur_scan"""
PARTS["cor_scan"] = f"""SELECT s.*, {mon('raw_d')} AS scan_m, {mon('lung_d')} AS lung_m,
  coalesce(raw_d < first_letter_d AND report_d >= first_letter_d, FALSE) AS moved,
  CASE WHEN raw_d < first_letter_d AND report_d >= first_letter_d THEN report_d ELSE raw_d END AS scan_d
FROM p_scan s LEFT JOIN (SELECT DISTINCT ParticipantID AS pid, first_letter_d FROM cl_invite) i ON s.ParticipantID = i.pid"""
PARTS["cl_scan"] = f"""SELECT *, {CATEGORY.format('days_first')} AS category FROM (
  SELECT *, datediff('day', first_d, scan_d) AS days_first FROM (
  SELECT *, min(CASE WHEN outcome_c = 'LDCT performed' THEN scan_d END) OVER (PARTITION BY ParticipantID) AS first_d FROM cor_scan))"""
PARTS["seq_scan"] = """SELECT ParticipantID, scan_d, row_number() OVER w AS seq, lag(scan_d) OVER w AS prev_d
FROM (SELECT DISTINCT ParticipantID, scan_d FROM cl_scan WHERE scan_d IS NOT NULL) WINDOW w AS (PARTITION BY ParticipantID ORDER BY scan_d)"""
PARTS["cl_diagnostics"] = f"""SELECT *, {mon('diagnosis_d')} AS diagnosis_m FROM (SELECT *, {dt('Cancer_Diagnosis_Date')} AS diagnosis_d, {dt('PET_CT_Date')} AS pet_d,
  {dt('Bronchoscopy_Date')} AS bronch_d, {dt('Pathology_Report_Date')} AS path_d FROM cur_diagnostics)"""
PARTS["cl_smoking"] = f"""SELECT *, {mon('offered_d')} AS offered_m, {mon('started_d')} AS started_m, {mon('ended_d')} AS ended_m,
  CASE WHEN flag IN ('N','NO') THEN 'NO' WHEN flag IN ('Y','YES') THEN 'YES' ELSE flag END AS completed_c
FROM (SELECT *, {dt('Date_Offered_Smoking_Cessation')} AS offered_d, {dt('Date_Started_Smoking_Cessation')} AS started_d,
  {dt('Date_Ended_Smoking_Cessation')} AS ended_d, upper(trim(Smoking_Cessation_Completed_Successfully)) AS flag FROM cur_smoking)"""

PERSON = "age_validity, age_band, age_band_five, age_band_eval, sex_c, ethnic_group, imd_decile, rurality"
PARTS["b_people"] = f"SELECT ParticipantID AS pid, CCG_Code AS ccg_code, {PERSON} FROM cl_demographics"
PARTS["n_org"] = "SELECT DISTINCT org_code, project_name_place FROM fx_project_names"
PARTS["n_area"] = "SELECT DISTINCT CCG_Code AS ccg, project_name_ccg FROM fx_project_names WHERE split_by_ccg = 1"


def named(view: str) -> str:
    return f"""SELECT t.*, p.* EXCLUDE (pid), coalesce(na.project_name_ccg, no.project_name_place) AS project
FROM {view} t LEFT JOIN b_people p ON t.ParticipantID = p.pid
LEFT JOIN n_org no ON t.org_code = no.org_code LEFT JOIN n_area na ON p.ccg_code = na.ccg"""


ELIG = "LEFT JOIN (SELECT ParticipantID AS epid, eligible, first_letter_d AS letter_d FROM cl_invite) e ON x.ParticipantID = e.epid"
FIRST = "LEFT JOIN (SELECT ParticipantID AS fpid, check_m, check_d FROM b_first) f ON x.ParticipantID = f.fpid"
PARTS["b_invites"] = named("cl_invite")
PARTS["b_checks"] = f"SELECT x.*, e.eligible, e.letter_d FROM ({named('cl_check')}) x {ELIG}"
VALID = "transaction_validity = 'Valid' AND person_validity = 'Valid'"
PARTS["b_first"] = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY ParticipantID
  ORDER BY CASE WHEN check_d > DATE '2019-03-31' THEN 0 ELSE 1 END, check_d, CSURowNumber, LHC_Date) AS rn
  FROM b_checks WHERE {VALID} AND eligible = 'Eligible' AND check_m IS NOT NULL AND attendance_c = 'Attended') WHERE rn = 1"""
PARTS["b_meas"] = f"SELECT x.*, e.eligible, e.letter_d, f.check_m, f.check_d FROM ({named('cl_measurement')}) x {ELIG} {FIRST}"
PARTS["b_scans"] = f"""SELECT x.*, e.eligible, e.letter_d, f.check_m, f.check_d, r.plco_r, r.llp_r FROM ({named('cl_scan')}) x {ELIG} {FIRST}
LEFT JOIN (SELECT ParticipantID AS rpid, plco_r, llp_r FROM cl_measurement) r ON x.ParticipantID = r.rpid"""
PARTS["b_diag"] = f"SELECT x.*, e.eligible, e.letter_d FROM ({named('cl_diagnostics')}) x {ELIG}"
PARTS["b_smoking"] = f"SELECT x.*, e.eligible, e.letter_d FROM ({named('cl_smoking')}) x {ELIG}"
PARTS["b_history"] = named("cur_history")

OTHER_TERMS = ["abdominal aortic aneurysm", "adrenal lesions", "aortic valve calcification", "bone abnormalities", "consolidation",
               "coronary calcification", "fractures with no trauma history", "liver or splenic lesions", "mediastinal mass",
               "osteoporosis", "other", "pleural effusions/thickening", "renal lesions", "suspicious breast lesion",
               "thoracic aortic aneurysm", "thyroid lesion", "tuberculosis", "other cancers"]
PULMONARY_TERMS = ["bronchiectasis", "respiratory bronchiolitis", "interstitial lung abnormalities (ilas)", "ila"]


def split(c: str) -> str:
    return f"string_split_regex(regexp_replace({c}, '([a-z])([A-Z][a-z])', '\\1-\\2', 'g'), '-| - |\\. ')"


def closest(tokens: str, terms: list[str]) -> str:
    values = ", ".join(f"('{t}')" for t in terms)
    return f"""SELECT token, term, dist FROM (SELECT token, term, round(1 - jaro_similarity(token, term), 9) AS dist,
  rank() OVER (PARTITION BY token ORDER BY round(1 - jaro_similarity(token, term), 9)) AS rk
  FROM (SELECT DISTINCT token FROM {tokens}) t, (VALUES {values}) v(term)) WHERE rk = 1"""


for part, column, terms in [("other", "Other_Incidental_Findings", OTHER_TERMS), ("pulm", "Pulmonary_Incidental_Findings", PULMONARY_TERMS)]:
    PARTS[f"tok_{part}"] = f"SELECT *, lower(unnest({split(column)})) AS token FROM b_scans WHERE {column} IS NOT NULL"
    PARTS[f"best_{part}"] = closest(f"tok_{part}", terms)
    PARTS[f"b_{part}"] = f"SELECT t.*, b.term, b.dist FROM tok_{part} t JOIN best_{part} b ON t.token = b.token"

# metric -> base, month column, condition, days
E = VALID + " AND eligible = 'Eligible'"
HIGH = "(plco_r = 'High risk' OR llp_r = 'High risk')"
DONE = "scan_m IS NOT NULL AND outcome_c = 'LDCT performed'"
SUM_OF: dict[str, tuple[str, str, str, str | None]] = {
    "1a": ("b_invites", "first_letter_m", E, None),
    "1c": ("(SELECT *, unnest([second_letter_m, call_m]) AS any_m FROM b_invites)", "any_m", E, None),
    "2": ("b_invites", "outcome_m", E + " AND accepted = 'Accepted'", None),
    "3a": ("b_first", "check_m", "delivery_c = 'F2F'", None),
    "3b": ("b_first", "check_m", "delivery_c = 'Virtual'", None),
    "3c": ("b_checks", "check_m", E + " AND attendance_c = 'DNA' AND delivery_c = 'F2F'", None),
    "3d": ("b_checks", "check_m", E + " AND attendance_c = 'DNA' AND delivery_c = 'Virtual'", None),
    "4a": ("b_meas", "check_m", f"{E} AND {HIGH}", None),
    "4b": ("b_meas", "check_m", f"{E} AND {HIGH} AND exclusion_c IS NOT NULL", None),
    "5a": ("b_scans", "scan_m", f"{VALID} AND {DONE} AND category = 'Initial scan'", None),
    "5b": ("b_scans", "scan_m", f"{VALID} AND scan_m IS NOT NULL AND outcome_c = 'LDCT did not attend' AND days_first < 0", None),
    "5d": ("b_scans", "scan_m", f"{VALID} AND {DONE} AND category = '3 month follow-up scan'", None),
    "5e": ("b_scans", "scan_m", f"{VALID} AND {DONE} AND category = '12 month follow-up scan'", None),
    "5f": ("b_scans", "scan_m", f"{VALID} AND {DONE} AND category = '24 month follow-up scan'", None),
    "5g": ("b_scans", "scan_m", f"{VALID} AND {DONE} AND category = '48 month follow-up scan'", None),
    "5h": ("b_scans", "scan_m", f"{VALID} AND {DONE} AND category = '2-year+ nodule surveillance'", None),
    "7s": ("b_pulm", "scan_m", f"{E} AND {DONE} AND dist <= 0.2 AND term IN ('interstitial lung abnormalities (ilas)', 'ila')", None),
    "7q": ("b_pulm", "scan_m", f"{E} AND {DONE} AND dist <= 0.2 AND term = 'bronchiectasis'", None),
    "7r": ("b_pulm", "scan_m", f"{E} AND {DONE} AND dist <= 0.2 AND term = 'respiratory bronchiolitis'", None),
    "7t": ("b_other", "scan_m", f"{E} AND {DONE} AND dist <= 0.3 AND term = 'other cancers'", None),
    "7t_alt": ("b_scans", "scan_m", f"{E} AND {DONE} AND other_d IS NOT NULL", None),
    "7u": ("b_scans", "scan_m", f"{E} AND {DONE} AND regexp_matches(upper(Emphysema_Extent), 'MODERATE|SEVERE')", None),
    "8b": ("b_smoking", "offered_m", E, None),
    "8a": ("b_smoking", "started_m", E + " AND offered_m IS NOT NULL", None),
    "9": ("b_smoking", "ended_m", E + " AND offered_m IS NOT NULL AND started_m IS NOT NULL AND completed_c = 'YES'", None),
    "10": ("b_first", "check_m", "TRUE", "datediff('day', letter_d, check_d)"),
    "11": ("b_scans", "scan_m", f"{E} AND {DONE} AND category = 'Initial scan'", "datediff('day', letter_d, scan_d)"),
    "12": ("b_scans", "scan_m", f"{E} AND {DONE} AND category = 'Initial scan'", "datediff('day', check_d, scan_d)"),
    "13": ("b_diag", "diagnosis_m", E, "datediff('day', letter_d, diagnosis_d)"),
    "14a": ("b_scans", "lung_m", f"{E} AND {DONE} AND {HIGH}", None),
}
for i, term in [("7a", "consolidation"), ("7b", "tuberculosis"), ("7c", "mediastinal mass"), ("7d", "coronary calcification"),
                ("7e", "aortic valve calcification"), ("7f", "thoracic aortic aneurysm"), ("7g", "pleural effusions/thickening"),
                ("7h", "suspicious breast lesion"), ("7i", "thyroid lesion"), ("7j", "liver or splenic lesions"), ("7k", "renal lesions"),
                ("7l", "adrenal lesions"), ("7m", "abdominal aortic aneurysm"), ("7n", "bone abnormalities"), ("7o", "osteoporosis"),
                ("7p", "fractures with no trauma history")]:
    far = 0.1 if i in ("7k", "7l") else 0.2
    SUM_OF[i] = ("b_other", "scan_m", f"{E} AND {DONE} AND dist <= {far} AND term = '{term}'", None)


def records(i: str) -> str:
    base, month, where, days = SUM_OF[i]
    if days:
        return f"SELECT ParticipantID, project, {month} AS month, {days} AS days FROM {base} x WHERE {where} AND {month} IS NOT NULL AND {days} >= 0"
    return f"SELECT ParticipantID, project, {month} AS month FROM {base} x WHERE {where} AND {month} IS NOT NULL"


def metric(i: str) -> str:
    if i == "7":
        rows = " UNION ALL ".join(records(j) for j in
                                  ["7a", "7b", "7c", "7d", "7e", "7f", "7g", "7h", "7i", "7j", "7k", "7l", "7m", "7n", "7o", "7p",
                                   "7q", "7r", "7s", "7t_alt", "7u"])
        return f"SELECT project, month, CAST(count(DISTINCT ParticipantID) AS BIGINT) AS numerator FROM ({rows}) GROUP BY 1, 2"
    if SUM_OF[i][3]:
        return f"SELECT project, month, CAST(median(days) AS DOUBLE) AS numerator FROM ({records(i)}) GROUP BY 1, 2"
    return f"SELECT project, month, CAST(count(DISTINCT ParticipantID) AS BIGINT) AS numerator FROM ({records(i)}) GROUP BY 1, 2"


METRIC_IDS = [*SUM_OF, "7"]

PARTS["stage_rows"] = """SELECT Place AS project, CAST(strptime('20' || Date || '01', '%Y%m%d') AS DATE) AS month, MetricID AS metric_id, Metric AS metric_name,
  TRY_CAST(Number AS DOUBLE) AS numerator FROM fx_stage_submissions WHERE Place NOT IN ('Project 3')"""
PARTS["m_all"] = " UNION ALL ".join(
    f"SELECT project, month, '{i}' AS metric_id, CAST(numerator AS DOUBLE) AS numerator FROM ({metric(i)})"
    for i in METRIC_IDS if i not in ("7t", "7t_alt")) + " UNION ALL SELECT project, month, metric_id, numerator FROM stage_rows"

# long metric rows of the reports
PARTS["rows_h"] = """SELECT project, month, CASE metric_id WHEN '4' THEN '4a' WHEN '14a' THEN '14' ELSE metric_id END AS metric_id, numerator FROM fx_metric_rows"""
