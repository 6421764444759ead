"""Queries on the event timeline, milestones, flows and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.checks import cohort_views as views
from cohortwise.checks.q_select import OUT, src
from cohortwise.checks.registry import query
from cohortwise.checks.sql_parts import E, PARTS, VALID
from cohortwise.functions import clean
from cohortwise.operators import aggregate
from cohortwise.plans import models, pathway, vocab
from cohortwise.sources import io

WIN = "BETWEEN DATE '2019-04-01' AND DATE '2024-03-31'"

PARTS["pool"] = """SELECT ParticipantID, string_agg(project, ', ' ORDER BY project) AS projects, first(project ORDER BY n DESC, project) AS project_mode,
 array_to_string(list_sort(list_distinct(flatten(list(tables)))), ', ') AS tables
FROM (SELECT ParticipantID, project, count(*) AS n, list(DISTINCT t) AS tables FROM (
 SELECT ParticipantID, project, 'invite' AS t FROM b_invites UNION ALL SELECT ParticipantID, project, 'oh' FROM b_history UNION ALL SELECT ParticipantID, project, 'lhc' FROM b_checks
 UNION ALL SELECT ParticipantID, project, 'meas' FROM b_meas UNION ALL SELECT ParticipantID, project, 'ldct' FROM b_scans UNION ALL SELECT ParticipantID, project, 'diag' FROM b_diag
 UNION ALL SELECT ParticipantID, project, 'smoking' FROM b_smoking)
 WHERE length(ParticipantID) >= 60 AND project IN (SELECT project FROM fx_projects WHERE phase IN ('Original', 'Onboarded')) AND ParticipantID IN (SELECT ParticipantID FROM cl_demographics)
 GROUP BY 1, 2) GROUP BY 1"""
PARTS["ev_invite"] = f"""SELECT ParticipantID, min(d) AS date FROM (SELECT ParticipantID, unnest([first_letter_d, second_letter_d, call_d, contact_d]) AS d FROM cl_invite
 UNION ALL SELECT ParticipantID, check_d FROM b_checks WHERE letter_d IS NULL) WHERE d {WIN} AND ParticipantID IN (SELECT ParticipantID FROM pool) GROUP BY 1"""
PARTS["ev_check"] = f"""SELECT ParticipantID, coalesce(min(own), min(other)) AS date FROM (
 SELECT ParticipantID, check_d AS own, NULL AS other FROM b_checks WHERE {VALID} AND attendance_c = 'Attended' AND check_d {WIN}
 UNION ALL SELECT ParticipantID, NULL, scan_d FROM cl_scan WHERE {VALID} AND scan_m IS NOT NULL AND scan_d {WIN}) WHERE ParticipantID IN (SELECT ParticipantID FROM pool) GROUP BY 1"""
PARTS["ev_scan"] = f"""SELECT DISTINCT ParticipantID, scan_d AS date, CASE category WHEN 'Not classified' THEN 'Other scan' ELSE category END AS event FROM cl_scan
 WHERE {VALID} AND scan_m IS NOT NULL AND outcome_c = 'LDCT performed' AND scan_d {WIN} AND ParticipantID IN (SELECT ParticipantID FROM pool)"""
PARTS["line"] = """SELECT ParticipantID, date, 'Invite date' AS event FROM ev_invite UNION ALL
 SELECT c.ParticipantID, date, CASE WHEN m.high THEN 'LHC Date high risk' ELSE 'LHC Date low risk' END FROM ev_check c
  LEFT JOIN (SELECT ParticipantID, (coalesce(plco_r, '') = 'High risk' OR coalesce(llp_r, '') = 'High risk') AS high FROM cl_measurement) m ON c.ParticipantID = m.ParticipantID
 UNION ALL SELECT ParticipantID, date, event FROM ev_scan"""
PARTS["ped"] = """SELECT p.ParticipantID, p.projects, p.project_mode, p.tables, l.date, l.event, p.ParticipantID || '#' || CAST(coalesce(l.run, 1) AS VARCHAR) AS event_key, CAST(date_trunc('month', l.date) AS DATE) AS event_month
FROM pool p LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY ParticipantID ORDER BY date, event) AS run FROM (SELECT DISTINCT ParticipantID, date, event FROM line)) l ON p.ParticipantID = l.ParticipantID"""

SITE = "CASE {0} WHEN 'C34' THEN 'Lung' WHEN 'C50' THEN 'Breast' WHEN 'C61' THEN 'Urological' WHEN 'D09' THEN 'Urological' WHEN 'C76' THEN '{1}' END"
PARTS["reg_now"] = "SELECT * FROM fx_registry WHERE DatasetId = (SELECT max(DatasetId) FROM fx_registry)"
PARTS["rap_now"] = "SELECT * FROM fx_rapid WHERE DatasetId = (SELECT max(DatasetId) FROM fx_rapid)"
PARTS["pat_now"] = "SELECT * FROM fx_pathway WHERE DatasetId = (SELECT max(DatasetId) FROM fx_pathway) AND EVENT_TYPE IN (6, 100)"
PARTS["rap_link"] = """SELECT DISTINCT TUMOUR_AVP_ID, TUMOUR_ID FROM (SELECT r.TUMOUR_AVP_ID, e.TUMOUR_ID, rank() OVER (PARTITION BY r.TUMOUR_AVP_ID ORDER BY abs(datediff('day', DIAGNOSISDATE, EVENT_DATE))) AS rk
 FROM rap_now r JOIN pat_now e ON r.ParticipantID = e.ParticipantID AND abs(datediff('day', DIAGNOSISDATE, EVENT_DATE)) <= 15) WHERE rk = 1"""
PARTS["diag_both"] = f"""SELECT TUMOUR_ID AS pk, ParticipantID, DIAGNOSISDATEBEST AS d, SITE_ICD10_3CHAR AS icd, substr(STAGE_BEST, 1, 1) AS stage_group, DIAG_TRUST AS trust, 'registry' AS source, {SITE.format('SITE_ICD10_3CHAR', 'Other')} AS site FROM reg_now
UNION ALL SELECT r.TUMOUR_AVP_ID, r.ParticipantID, DIAGNOSISDATE, TUMOUR_SITE, substr(STAGE, 1, 1), TRUST_CODE, 'rapid', {SITE.format('TUMOUR_SITE', 'Unknown')} FROM rap_now r LEFT JOIN rap_link k ON r.TUMOUR_AVP_ID = k.TUMOUR_AVP_ID
 WHERE DIAGNOSISDATE > (SELECT max(DIAGNOSISDATEBEST) FROM reg_now) AND (k.TUMOUR_ID IS NULL OR k.TUMOUR_ID NOT IN (SELECT TUMOUR_ID FROM reg_now))"""
PARTS["diag_all"] = """SELECT * EXCLUDE (mark, ps, pm, pd) FROM (SELECT *, lag(source) OVER w AS ps, lag(mark) OVER w AS pm, lag(d) OVER w AS pd FROM
 (SELECT *, ParticipantID || '|' || icd || '|' || coalesce(CASE WHEN stage_group NOT IN ('?', 'U') THEN stage_group END, 'NA') || '|' || trust AS mark FROM diag_both)
 WINDOW w AS (PARTITION BY ParticipantID ORDER BY d, source, mark, pk)) WHERE NOT coalesce(ps <> source AND pm = mark AND datediff('day', pd, d) < 100, FALSE)"""
ORD = "CASE event WHEN 'Invite date' THEN 1 WHEN 'LHC Date low risk' THEN 3 WHEN 'Initial scan' THEN 4 WHEN 'LHC Date high risk' THEN 5 WHEN '3 month follow-up scan' THEN 6 WHEN '12 month follow-up scan' THEN 7 WHEN '24 month follow-up scan' THEN 8 WHEN '48 month follow-up scan' THEN 9 WHEN '2-year+ nodule surveillance' THEN 10 WHEN 'Other scan' THEN 11 END"
PARTS["ev_diag"] = f"""SELECT pk, event_key, days FROM (SELECT g.pk, p.event_key, datediff('day', p.date, g.d) AS days, row_number() OVER (PARTITION BY g.pk ORDER BY datediff('day', p.date, g.d), {ORD}, p.event_key) AS rn
 FROM diag_all g JOIN ped p ON g.ParticipantID = p.ParticipantID AND p.date <= g.d) WHERE rn = 1"""
PARTS["ped_diag"] = """SELECT p.*, e.pk, e.days, g.d AS diagnosis_date, g.site, g.stage_group, g.source, CASE WHEN e.pk IS NOT NULL THEN p.event NOT IN ('Invite date', 'LHC Date low risk') END AS later
FROM ped p LEFT JOIN ev_diag e ON p.event_key = e.event_key LEFT JOIN diag_all g ON e.pk = g.pk"""


# What these queries read more than once.
STAGED = {"lines", "invite", "measurement", "persons", "check", "checks", "scan", "clean_scans", "pool", "events", "timeline", "diagnoses", "cube"}
MILESTONES_STAGED = STAGED | {"smoking"}


@query("people_universe", "SELECT ParticipantID, projects, project_mode, tables FROM pool")
def people_universe(spark, path):
    return pathway.people(views.cohort(spark, path, {"lines"}))


@query("people_events", "SELECT ParticipantID, projects, project_mode, tables, date, event, event_key, event_month FROM ped")
def people_events(spark, path):
    return pathway.people_events(views.cohort(spark, path, staged=STAGED, keep=views.KEEP_EVENTS)).select(
        "ParticipantID", "projects", "project_mode", "tables", "date", "event", "event_key", "event_month")


@query("funnel_timeline", "SELECT step_no, step, people, round(100.0 * people / max(CASE WHEN step_no = 1 THEN people END) OVER (), 2) AS perc FROM ("
       "SELECT 1 AS step_no, 'people' AS step, count(DISTINCT ParticipantID) AS people FROM pool UNION ALL SELECT 2, 'invites', count(DISTINCT ParticipantID) FROM ev_invite UNION ALL "
       "SELECT 3, 'checks', count(DISTINCT ParticipantID) FROM ev_check UNION ALL SELECT 4, 'scans', count(DISTINCT ParticipantID) FROM ev_scan UNION ALL SELECT 5, 'events', count(DISTINCT ParticipantID) FROM line)")
def funnel_timeline(spark, path):
    return pathway.funnel_steps(views.cohort(spark, path, staged=STAGED, keep=views.KEEP_EVENTS))


@query("consolidated_diagnoses", "SELECT pk, ParticipantID, d AS diagnosis_date, icd AS icd10_3c, stage_group, trust AS trust_code, source, site AS tumour_site_group FROM diag_all")
def consolidated_diagnoses(spark, path):
    columns = ["pk", "ParticipantID", "diagnosis_date", "icd10_3c", "stage_group", "trust_code", "source", "tumour_site_group"]
    return views.all_diagnoses(views.cohort(spark, path, {"lines"}), spark, columns).select(*columns)


def linked(spark, path):
    c = views.cohort(spark, path, staged=STAGED, keep=views.KEEP_EVENTS)
    events = c.stage(pathway.people_events(c), "events", "ParticipantID", placed=True)
    return pathway.link_diagnoses(events, c.stage(views.all_diagnoses(c, spark, views.KEEP_EVENTS["diagnoses"]), "diagnoses", "ParticipantID", placed=True))


@query("event_diagnosis_link", "SELECT ParticipantID, event_key, event, date, pk, CAST(days AS INTEGER) AS days_diff, diagnosis_date, site AS tumour_site_group, later AS at_check_or_later FROM ped_diag")
def event_diagnosis_link(spark, path):
    return linked(spark, path).select("ParticipantID", "event_key", "event", "date", "pk", "days_diff", "diagnosis_date", "tumour_site_group", "at_check_or_later")


PARTS["quitters"] = """SELECT ParticipantID, min(s) AS s FROM (
 SELECT ParticipantID, 1 AS s FROM cl_measurement WHERE Smoking_Cessation_Offered IS NOT NULL AND lower(Smoking_Cessation_Offered) NOT LIKE '%current%' AND trim(Smoking_Cessation_Offered) NOT IN ('NA','NULL','','No','N')
 UNION ALL SELECT ParticipantID, 1 FROM cl_smoking WHERE Date_Offered_Smoking_Cessation IS NOT NULL
 UNION ALL SELECT ParticipantID, 2 FROM cl_check WHERE Total_Quit_Period > 0 OR (Date_Stopped_Smoking IS NOT NULL AND Date_Stopped_Smoking NOT IN ('0','N/A','00:00.0','12:00:00 AM') AND coalesce(Total_Quit_Period, 0) = 0)) GROUP BY 1"""
SMOKE = "CASE q.s WHEN 1 THEN 'Current smoker' WHEN 2 THEN 'Previous smoker' ELSE 'Unknown' END"


@query("precedence_flag", f"SELECT d.ParticipantID, {SMOKE} AS smoking_status FROM cl_demographics d LEFT JOIN quitters q ON d.ParticipantID = q.ParticipantID")
def precedence_flag(spark, path):
    c = views.cohort(spark, path)
    return pathway.smoking_status(c.demographics, c.current("measurement"), c.current("smoking"), c.current("check"))


PARTS["last_scan"] = f"""SELECT ParticipantID, max(scan_d) AS last_scan, count(DISTINCT scan_d) AS n FROM cl_scan WHERE {VALID} AND scan_m IS NOT NULL AND outcome_c = 'LDCT performed' GROUP BY 1"""


@query("awaiting_result_flag", "SELECT ParticipantID, last_scan, datediff('day', last_scan, DATE '2023-08-31' - 185) <= 0 AS awaiting FROM last_scan")
def awaiting_result_flag(spark, path):
    return pathway.awaiting_flags(views.cohort(spark, path, {"scan"}).clean_scans)


PARTS["check_sum"] = f"""SELECT ParticipantID, methods, CASE WHEN n <= 1 THEN '1 x contacts' WHEN n = 2 THEN '2 x contacts' ELSE '3+ contacts' END AS contact_group,
 coalesce(CASE WHEN coded = n THEN CASE best WHEN 1 THEN 'LHC Attended' WHEN 2 THEN 'LHC Incomplete' ELSE 'LHC DNA' END END, 'No LHC') AS attendance,
 CASE WHEN coded = n AND best = 1 THEN last_d <= DATE '2023-08-31' END AS before_0, CASE WHEN coded = n AND best = 1 THEN last_d <= DATE '2023-08-31' - 185 END AS before_185,
 CASE WHEN coded = n AND best = 1 THEN last_d <= DATE '2023-08-31' - 45 END AS before_45
FROM (SELECT ParticipantID, count(*) AS n, count(r) AS coded, min(r) AS best, max(check_d) AS last_d, array_to_string(list_sort(list(DISTINCT delivery_c)), ', ') AS methods
 FROM (SELECT *, CASE attendance_c WHEN 'Attended' THEN 1 WHEN 'Partially attended' THEN 2 WHEN 'DNA' THEN 3 END AS r FROM b_checks
  WHERE {E} AND check_m IS NOT NULL AND attendance_c <> 'NULL response' AND delivery_c NOT IN ('NULL response', 'NOT CODED')) GROUP BY 1)"""
PARTS["meas_sum"] = f"""SELECT ParticipantID, risk, CASE WHEN risk = 'High risk' THEN CASE WHEN exclusion_c IS NULL THEN 'LDCT: referred' ELSE 'LDCT: ineligible' END END AS referral
FROM (SELECT *, CASE WHEN plco_r = 'High risk' OR llp_r = 'High risk' THEN 'High risk' WHEN plco_r IS NOT NULL OR llp_r IS NOT NULL THEN 'Low risk' END AS risk FROM b_meas WHERE {E})"""
PARTS["lung"] = """SELECT ParticipantID, outcome AS cancer_outcome, CASE WHEN outcome LIKE 'Programme%' THEN 'Programme: ' ELSE 'C: ' END || st AS cancer_stage FROM (SELECT ParticipantID,
 CASE WHEN later AND days <= 185 THEN 'Programme: lung cancer' ELSE 'Counterfactual: lung cancer' END AS outcome,
 CASE WHEN stage_group IN ('1','2') THEN 'S 1-2' WHEN stage_group IN ('3','4') THEN 'S 3-4' ELSE 'S ?' END AS st, row_number() OVER (PARTITION BY ParticipantID ORDER BY days, pk) AS rn FROM ped_diag WHERE site = 'Lung') WHERE rn = 1"""


@query("outcome_attribution", "SELECT ParticipantID, cancer_outcome, cancer_stage FROM lung")
def outcome_attribution(spark, path):
    return pathway.attribute_outcomes(linked(spark, path))


PARTS["inv_seq"] = f"""SELECT ParticipantID, project, imd_decile, rurality, ethnic_group, sex_c AS sex, age_band_eval, o,
 CASE WHEN f IS NOT NULL AND s IS NOT NULL THEN 'Invite 1 No response' WHEN f IS NOT NULL THEN 'Invite 1 ' || o END AS invite_1,
 CASE WHEN s IS NOT NULL AND t IS NOT NULL THEN 'Invite 2 No response' WHEN s IS NOT NULL THEN 'Invite 2 ' || o END AS invite_2, CASE WHEN t IS NOT NULL THEN 'Invite 3 ' || o END AS invite_3
FROM (SELECT *, coalesce(first_letter_d, second_letter_d, call_d) AS f, coalesce(second_letter_d, call_d) AS s, call_d AS t, {OUT} AS o FROM b_invites) WHERE ParticipantID IN (SELECT ParticipantID FROM pool)"""
PARTS["miles_raw"] = f"""SELECT i.ParticipantID, i.project, 'GP eligible population' AS eligible_population, i.invite_1, i.invite_2, i.invite_3, 'Invite ' || i.o AS invite_outcome, i.imd_decile, i.rurality, i.ethnic_group,
 i.sex, i.age_band_eval, {SMOKE} AS smoking_status, p.phase, p.CAName, p.invite_mode, p.lhc_delivery, p.triage_before_risk_assessment, p.admin, c.methods, c.contact_group, c.attendance,
 c.before_0 AS check_before_end, c.before_185 AS check_before_end_185, c.before_45 AS check_before_end_45, coalesce(m.risk, CASE WHEN c.attendance IS NOT NULL OR l.n IS NOT NULL THEN 'No risk score' END) AS risk,
 coalesce(m.referral, CASE WHEN l.n IS NOT NULL THEN 'LDCT: unknown' END) AS referral, CASE WHEN l.n = 1 THEN '1 x scan' WHEN l.n = 2 THEN '2 x scans' WHEN l.n > 2 THEN '3+ scans' END AS scan_group,
 g.cancer_outcome, g.cancer_stage, l.last_scan
FROM inv_seq i LEFT JOIN quitters q ON i.ParticipantID = q.ParticipantID LEFT JOIN fx_projects p ON i.project = p.project LEFT JOIN check_sum c ON i.ParticipantID = c.ParticipantID
LEFT JOIN meas_sum m ON i.ParticipantID = m.ParticipantID LEFT JOIN last_scan l ON i.ParticipantID = l.ParticipantID LEFT JOIN lung g ON i.ParticipantID = g.ParticipantID"""
PARTS["miles"] = """SELECT * EXCLUDE (last_scan) REPLACE (coalesce(attendance, CASE WHEN risk IS NOT NULL THEN 'No attendance' END) AS attendance,
 CASE WHEN cancer_outcome IS NOT NULL THEN cancer_outcome WHEN scan_group IS NULL THEN 'No lung cancer' WHEN last_scan >= DATE '2023-08-31' - 185 THEN 'Scanned: Awaiting results' ELSE 'Scanned: No lung cancer' END AS cancer_outcome) FROM miles_raw"""
PARTS["mcube"] = "SELECT * EXCLUDE (ParticipantID), count(DISTINCT ParticipantID) AS participants FROM miles GROUP BY ALL"


def milestone_rows(spark, path):
    c = views.cohort(spark, path, staged=MILESTONES_STAGED, keep=views.KEEP_EVENTS)
    return pathway.milestones(c, views.all_diagnoses(c, spark, views.KEEP_EVENTS["diagnoses"]))


def cube(spark, path):
    c = views.cohort(spark, path, staged=MILESTONES_STAGED, keep=views.KEEP_EVENTS)
    return c.stage(pathway.cube(pathway.milestones(c, views.all_diagnoses(c, spark, views.KEEP_EVENTS["diagnoses"]))), "cube")


@query("person_milestones", "SELECT * FROM miles")
def person_milestones(spark, path):
    return milestone_rows(spark, path)


EDGES = [("o_orderstatus", "l_returnflag", "o_orderpriority"), ("l_returnflag", "l_linestatus", "o_orderpriority")]
FLOWBASE = "(SELECT o_orderstatus, o_orderpriority, nullif(l_returnflag, 'N') AS l_returnflag, CASE WHEN l_linenumber < 4 THEN l_linestatus END AS l_linestatus, count(DISTINCT o_custkey) AS participants FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4)"


@query("flow_edges", " UNION ALL ".join(
    f"SELECT {i} AS step, {a} AS origin, coalesce({b}, {o}) AS destination, CASE WHEN {b} IS NOT NULL THEN 'direct' ELSE 'outcome' END AS via, CAST(sum(participants) AS BIGINT) AS flow FROM {FLOWBASE} WHERE {a} IS NOT NULL GROUP BY 2, 3, 4"
    for i, (a, b, o) in enumerate(EDGES, 1)))
def flow_edges(spark, path):
    s = src(spark, path)
    base = s.table("lineitem").join(s.table("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "o_orderstatus", "o_orderpriority", clean.null_if("l_returnflag", "N").alias("l_returnflag"),
        F.when(F.col("l_linenumber") < 4, F.col("l_linestatus")).alias("l_linestatus"))
    counts = base.groupBy("o_orderstatus", "o_orderpriority", "l_returnflag", "l_linestatus").agg(F.countDistinct("o_custkey").alias("participants"))
    return pathway.flow_edges(counts, EDGES)


def step_sql(i, a, b, o, where="TRUE", origin=None, missing="NULL"):
    origin = origin or a
    return (f"SELECT {i} AS step, {origin} AS origin, coalesce({b}, {o}, {missing}) AS destination, CASE WHEN {b} IS NOT NULL THEN 'direct' ELSE 'outcome' END AS via, "
            f"CAST(sum(participants) AS BIGINT) AS flow FROM mcube WHERE {origin} IS NOT NULL AND {where} GROUP BY 2, 3, 4")


PARTS["flows"] = " UNION ALL ".join(
    [step_sql(i, a, b, o, missing="'Not scanned'") for i, (a, b, o) in enumerate(pathway.FLOW_STEPS, 1)]
    + [step_sql(11, "scan_group", "cancer_outcome", "cancer_outcome", origin="coalesce(scan_group, 'Not scanned')"),
       step_sql(12, "cancer_outcome", "cancer_stage", "cancer_stage", where="cancer_stage IS NOT NULL")])


@query("flow_table", "SELECT step, origin, destination, via, flow FROM flows")
def flow_table(spark, path):
    return pathway.flow_table(cube(spark, path))


@query("flow_nodes", "SELECT destination AS name, CAST(sum(flow) AS BIGINT) AS flow, round(100.0 * CAST(sum(flow) AS DOUBLE) / (SELECT CAST(sum(flow) AS DOUBLE) FROM flows WHERE origin = 'GP eligible population'), 1) AS flow_perc FROM flows GROUP BY 1")
def flow_nodes(spark, path):
    return pathway.flow_nodes(pathway.flow_table(cube(spark, path)))


@query("breakdown_counts", """SELECT l.invite_outcome, coalesce(CAST(5 * round_even(n / 5, 0) AS BIGINT), 0) AS n FROM (SELECT DISTINCT invite_outcome FROM mcube) l
LEFT JOIN (SELECT invite_outcome, sum(participants) AS n FROM mcube WHERE sex IN ('Female') AND invite_mode IN ('Opt-in', 'Opt-out') GROUP BY 1) f ON l.invite_outcome = f.invite_outcome""")
def breakdown_counts(spark, path):
    return pathway.breakdown(cube(spark, path), "invite_outcome", {"sex": ["Female"], "invite_mode": ["Opt-in", "Opt-out"]})


def sum_if(cond: str, name: str) -> str:
    return f"CAST(coalesce(sum(participants) FILTER ({cond}), 0) AS BIGINT) AS {name}"


MEASURED = ", ".join(sum_if(c, n) for n, c in [
    ("invites_first", "invite_1 IS NOT NULL"), ("invites_second", "invite_2 IS NOT NULL"), ("invites_third", "invite_3 IS NOT NULL"),
    ("attended_f2f", "attendance = 'LHC Attended' AND methods = 'F2F'"), ("attended_virtual", "attendance = 'LHC Attended' AND methods = 'Virtual'"),
    ("attended_hybrid", "attendance = 'LHC Attended' AND methods = 'F2F, Virtual'"), ("attended", "attendance = 'LHC Attended'"), ("referred", "risk = 'High risk'"),
    ("scanned", "scan_group IS NOT NULL"), ("programme_cancer", "cancer_outcome = 'Programme: lung cancer'"), ("counterfactual_cancer", "cancer_outcome = 'Counterfactual: lung cancer'"),
    ("scanned_no_cancer", "cancer_outcome = 'Scanned: No lung cancer'"), ("programme_s12", "cancer_stage = 'Programme: S 1-2'"), ("programme_s34", "cancer_stage = 'Programme: S 3-4'"),
    ("programme_s_unknown", "cancer_stage = 'Programme: S ?'")])


def measures_sql(parts: list[str]) -> str:
    return ("SELECT *, invites_second + invites_third AS invites_followup, invites_first + invites_second + invites_third AS invites_total, round(attended / nullif(CAST(invites_first AS DOUBLE), 0), 4) AS uptake, "
            "round(referred / nullif(CAST(attended AS DOUBLE), 0), 4) AS conversion_eligible, round(scanned / nullif(CAST(attended AS DOUBLE), 0), 4) AS conversion_realised FROM ("
            + " UNION ALL ".join(parts) + ")")


@query("group_measures", measures_sql([f"SELECT invite_mode, {MEASURED} FROM mcube WHERE invite_mode IS NOT NULL AND check_before_end_185 GROUP BY 1"]))
def group_measures(spark, path):
    return pathway.group_measures(cube(spark, path), "invite_mode")


# Reporting groups of the measures, as the twin states them.
GROUP_SQL = {
    "total": "'Total'", "gender": "sex", "invite model": "invite_mode", "check model": "lhc_delivery", "alliance": "CAName", "project": "project",
    "deprivation": "CASE WHEN imd_decile IN (1, 2) THEN 'Q1' WHEN imd_decile BETWEEN 3 AND 10 THEN 'Q2-5' ELSE 'Not known' END",
    "age": "CASE age_band_eval WHEN '55-64' THEN '55-64yrs' WHEN '65-74' THEN '65-74yrs' WHEN '75' THEN '75yrs' WHEN 'Other' THEN 'Other' WHEN 'Age below zero' THEN 'Other' ELSE 'Not known' END",
    "ethnicity": "CASE WHEN ethnic_group IN ('White', 'Not known') THEN ethnic_group WHEN ethnic_group IN ('Asian or Asian British', 'Black or Black British', 'Mixed', 'Other Ethnic Group') THEN 'Other ethnicities' END",
    "triage": "CASE triage_before_risk_assessment WHEN 'Unknown' THEN 'Not known' ELSE triage_before_risk_assessment END",
    "admin": "CASE admin WHEN 'Unknown' THEN 'Not known' ELSE admin END",
}


@query("group_measures_all", measures_sql([f"SELECT '{g}' AS grouping, {c} AS level, {MEASURED} FROM mcube WHERE ({c}) IS NOT NULL AND check_before_end_185 GROUP BY 2" if g != "total" else
                                           f"SELECT 'total' AS grouping, 'Total' AS level, {MEASURED} FROM mcube WHERE check_before_end_185 HAVING count(*) > 0" for g, c in GROUP_SQL.items()]))
def group_measures_all(spark, path):
    return pathway.measures_by_group(cube(spark, path), pathway.GROUPINGS)


# --- models

ODDS = "(SELECT o_custkey % 2 = 0 AS e, o_orderpriority = '1-URGENT' AS k, count(*) AS w FROM orders GROUP BY 1, 2)"


@query("odds_ratio_2x2", f"""SELECT a, b, c, d, round(a * d / (b * c), 4) AS odds_ratio, round(exp(ln(a * d / (b * c)) - 1.96 * sqrt(1/a + 1/b + 1/c + 1/d)), 4) AS lower,
 round(exp(ln(a * d / (b * c)) + 1.96 * sqrt(1/a + 1/b + 1/c + 1/d)), 4) AS upper FROM (SELECT CAST(sum(w) FILTER (e AND k) AS DOUBLE) AS a, CAST(sum(w) FILTER (e AND NOT k) AS DOUBLE) AS b,
 CAST(sum(w) FILTER (NOT e AND k) AS DOUBLE) AS c, CAST(sum(w) FILTER (NOT e AND NOT k) AS DOUBLE) AS d FROM {ODDS})""")
def odds_ratio_2x2(spark, path):
    counts = src(spark, path).table("orders").groupBy((F.col("o_custkey") % 2 == 0).alias("e"), (F.col("o_orderpriority") == "1-URGENT").alias("k")).agg(
        F.count(F.lit(1)).alias("w"))
    return models.odds_ratio_2x2(counts, F.col("e"), F.col("k"), "w")


def odds_model(spark, path):
    """The same odds from a fitted model: one two-level factor has a closed form."""
    counts = src(spark, path).table("orders").select((F.col("o_custkey") % 2 == 0).cast("string").alias("e"), (F.col("o_orderpriority") == "1-URGENT").alias("k"))
    counts = counts.groupBy("e", "k").agg(F.count(F.lit(1)).alias("w"))
    return models.odds_ratio_model(counts, F.col("k"), ["e"], "w")


@query("odds_ratio_fit", f"""SELECT 'e=true' AS term, round(a * d / (b * c), 3) AS odds_ratio, round(exp(ln(a * d / (b * c)) - 1.96 * sqrt(1/a + 1/b + 1/c + 1/d)), 3) AS lower,
 round(exp(ln(a * d / (b * c)) + 1.96 * sqrt(1/a + 1/b + 1/c + 1/d)), 3) AS upper FROM (SELECT CAST(sum(w) FILTER (e AND k) AS DOUBLE) AS a, CAST(sum(w) FILTER (e AND NOT k) AS DOUBLE) AS b,
 CAST(sum(w) FILTER (NOT e AND k) AS DOUBLE) AS c, CAST(sum(w) FILTER (NOT e AND NOT k) AS DOUBLE) AS d FROM {ODDS})""")
def odds_ratio_fit(spark, path):
    return odds_model(spark, path).select("term", *[F.round(c, 3).alias(c) for c in ("odds_ratio", "lower", "upper")])


@query("odds_ratio_model")
def odds_ratio_model(spark, path):
    s = src(spark, path)
    rows = s.table("orders").join(s.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    counts = rows.groupBy("o_orderstatus", "c_mktsegment", "o_orderpriority").agg(F.count(F.lit(1)).alias("w"))
    return models.odds_ratio_model(counts, F.col("o_orderpriority") == "1-URGENT", ["o_orderstatus", "c_mktsegment"], "w")


# Factors of the pathway regressions and their reference levels.
REFERENCES = {"sex": "Female", "ethnic_group": "White", "smoking_status": "Current smoker", "invite_mode": "Opt-in"}
OUTCOMES = {"pathway_odds_attended": ("attendance", "LHC Attended"), "pathway_odds_scanned": ("scan_group", None)}


def _odds(name: str, column: str, value: str | None):
    hit = f"{column} = '{value}'" if value else f"{column} IS NOT NULL"
    counts = " UNION ALL ".join(
        f"SELECT '{f}' AS factor, {f} AS level, '{r}' AS reference, CAST(coalesce(sum(participants) FILTER ({hit}), 0) AS DOUBLE) AS cases, "
        f"CAST(coalesce(sum(participants) FILTER (({hit}) IS NOT TRUE), 0) AS DOUBLE) AS others FROM mcube WHERE {f} IS NOT NULL GROUP BY 2" for f, r in REFERENCES.items())
    whole = "cases > 0 AND others > 0 AND c > 0 AND d > 0"
    odds, se = "ln(cases * d / (others * c))", "sqrt(1 / cases + 1 / others + 1 / c + 1 / d)"

    @query(name, f"""WITH n AS ({counts}) SELECT n.factor, level, reference, cases, others, CASE WHEN {whole} THEN round(exp({odds}), 4) END AS odds_ratio,
 CASE WHEN {whole} THEN round(exp({odds} - 1.96 * {se}), 4) END AS lower, CASE WHEN {whole} THEN round(exp({odds} + 1.96 * {se}), 4) END AS upper
FROM n LEFT JOIN (SELECT factor, cases AS c, others AS d FROM n WHERE level = reference) b ON n.factor = b.factor""")
    def run(spark, path):
        case = F.col(column) == value if value else F.col(column).isNotNull()
        return models.odds_by_level(cube(spark, path), case, REFERENCES, "participants")


for _name, _outcome in OUTCOMES.items():
    _odds(_name, *_outcome)


# Segments whose conversions are reported, and those of them that are crossed.
POOR, OTHER = "imd_decile IN (1, 2)", "imd_decile BETWEEN 3 AND 10"
MODES = [("opt in", "invite_mode = 'Opt-in'"), ("opt out", "invite_mode = 'Opt-out'")]
CROSSED = [("quintile 1", POOR), ("quintiles 2 to 5", OTHER), ("age 55 to 64", "age_band_eval = '55-64'"), ("age 65 to 74", "age_band_eval = '65-74'")]
SEGMENTS = [
    ("all", "TRUE"), *MODES, ("combined", "invite_mode = 'Combined'"), ("opt in or out", "invite_mode IN ('Opt-in', 'Opt-out')"),
    ("triage", "triage_before_risk_assessment = 'Yes'"), ("no triage", "triage_before_risk_assessment = 'No'"),
    ("face to face", "lhc_delivery = 'Face-to-face'"), ("virtual", "lhc_delivery = 'Virtual'"), ("hybrid", "lhc_delivery = 'Hybrid'"),
    ("in-house", "admin = 'In-house'"), ("outsourced", "admin = 'Outsourced'"), ("original", "phase = 'Original'"), ("onboarded", "phase = 'Onboarded'"),
    *CROSSED, ("age 75", "age_band_eval = '75'"), ("female", "sex = 'Female'"), ("male", "sex = 'Male'"), ("white", "ethnic_group = 'White'"),
    ("other ethnicities", "ethnic_group IN ('Asian or Asian British', 'Black or Black British', 'Mixed', 'Other Ethnic Group')"),
    ("current smoker", "smoking_status = 'Current smoker'"), ("previous smoker", "smoking_status = 'Previous smoker'"), ("smoking unknown", "smoking_status = 'Unknown'"),
    *[(f"{a}, {b}", f"{c} AND {d}") for a, c in CROSSED for b, d in MODES],
]


def _conversion(name: str, base: str, hit: str):
    @query(name, " UNION ALL ".join(
        f"SELECT '{n}' AS segment, CAST(coalesce(sum(participants) FILTER ({base}), 0) AS BIGINT) AS base, CAST(coalesce(sum(participants) FILTER (({base}) AND {hit}), 0) AS BIGINT) AS hit, "
        f"round(coalesce(sum(participants) FILTER (({base}) AND {hit}), 0) / nullif(CAST(coalesce(sum(participants) FILTER ({base}), 0) AS DOUBLE), 0), 4) AS conversion FROM mcube WHERE {c} HAVING count(*) > 0" for n, c in SEGMENTS))
    def run(spark, path):
        return aggregate.segment_ratios(cube(spark, path), {n: F.coalesce(F.expr(c), F.lit(False)) for n, c in SEGMENTS}, "participants",
                                        F.coalesce(F.expr(base), F.lit(False)), F.coalesce(F.expr(f"({base}) AND {hit}"), F.lit(False)))


_conversion("lhc_conversion", "invite_1 IS NOT NULL", "attendance = 'LHC Attended'")
_conversion("ct_conversion", "attendance = 'LHC Attended'", "scan_group IS NOT NULL")


@query("impute_median", "SELECT ParticipantID, coalesce(age_n, (SELECT median(age_n) FROM cl_demographics)) AS age FROM cl_demographics")
def impute_median(spark, path):
    return models.impute_median(views.cohort(spark, path).demographics.select("ParticipantID", "age"), "age")


@query("tree_predictions")
def tree_predictions(spark, path):
    c = views.cohort(spark, path, staged={"tree_rows"})
    rows = c.clean_invites.select("ParticipantID", pathway.invite_outcome("Invite_Outcome").alias("outcome")).join(
        c.demographics.select("ParticipantID", "age", "sex", "ethnic_group", F.coalesce("marital_status", F.lit("Not known")).alias("marital_status"), F.coalesce("rurality", F.lit("Not known")).alias("rurality"),
                              F.coalesce(clean.deciles_to_quintiles("imd_decile").cast("string"), F.lit("Not known")).alias("quintile")), "ParticipantID")
    rows = c.stage(rows, "tree_rows")
    return models.tree_predictions(rows, F.col("outcome") == "Declined", ["age"], ["sex", "marital_status", "ethnic_group", "rurality", "quintile"], "ParticipantID",
                                   stage=io.staged(spark))
