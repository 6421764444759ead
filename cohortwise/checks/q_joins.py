"""Queries on lookups, nearest-date, as-of and closest-text joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.checks import cohort_views as views
from cohortwise.checks.registry import query
from cohortwise.checks.q_select import lines, src
from cohortwise.operators import aggregate, joins, select
from cohortwise.plans import diagnoses, reports, vocab
from cohortwise.functions import dates

# The six terms that part names are matched to.
PART_TERMS = ["small ring", "red widget", "blue bolt", "hot gear", "old gizmo", "cold spring"]


@query("enrich_lookups", "SELECT ParticipantID, lsoa_name, imd_decile, rurality_code, ethnic_group FROM cl_demographics")
def enrich_lookups(spark, path):
    return views.cohort(spark, path).demographics.select("ParticipantID", "lsoa_name", "imd_decile", "rurality_code", "ethnic_group")


@query("demographic_enrich", "SELECT ParticipantID, ccg_code, sex_c AS sex, age_band, imd_decile, project FROM b_smoking")
def demographic_enrich(spark, path):
    return views.cohort(spark, path).smoking.select("ParticipantID", "ccg_code", "sex", "age_band", "imd_decile", "project")


@query("two_key_naming", """SELECT c_custkey, coalesce(na.project_name_ccg, no.project_name_place) AS project FROM customer
LEFT JOIN n_org no ON 'ORG0' || CAST(c_custkey % 7 AS VARCHAR) = no.org_code LEFT JOIN n_area na ON CAST(c_nationkey % 7 AS VARCHAR) = na.ccg""")
def two_key_naming(spark, path):
    s = src(spark, path)
    df = s.table("customer").select("c_custkey", F.concat(F.lit("ORG0"), (F.col("c_custkey") % 7).cast("string")).alias("org_code"),
                                    (F.col("c_nationkey") % 7).cast("string").alias("ccg_code"))
    return joins.name_projects(df, s.fx("fx_project_names")).select("c_custkey", "project")


@query("eligibility_join", "SELECT ParticipantID, CSURowNumber, eligible, letter_d AS first_letter_date FROM b_checks")
def eligibility_join(spark, path):
    return views.cohort(spark, path).checks.select("ParticipantID", "CSURowNumber", "eligible", "first_letter_date")


@query("risk_join", "SELECT ParticipantID, LDCT_Date, CSURowNumber, plco_r AS plco_risk, llp_r AS llp_risk FROM b_scans")
def risk_join(spark, path):
    return views.cohort(spark, path).scans.select("ParticipantID", "LDCT_Date", "CSURowNumber", "plco_risk", "llp_risk")


@query("first_check_join", "SELECT ParticipantID, check_m AS check_month, check_d AS check_date, plco_r AS plco_risk FROM b_meas")
def first_check_join(spark, path):
    return views.cohort(spark, path).measurements.select("ParticipantID", "check_month", "check_date", "plco_risk")


@query("composite_join", """SELECT l_orderkey, l_linenumber, l_quantity, n FROM lineitem LEFT JOIN (SELECT l_orderkey AS k, l_linenumber AS ln, count(*) AS n FROM lineitem
 WHERE l_returnflag <> 'N' GROUP BY 1, 2) x ON l_orderkey = k AND l_linenumber = ln""")
def composite_join(spark, path):
    rows = src(spark, path).table("lineitem")
    counts = rows.filter("l_returnflag <> 'N'").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    return rows.select("l_orderkey", "l_linenumber", "l_quantity").join(counts, ["l_orderkey", "l_linenumber"], "left")


@query("template_cross", """SELECT n_name, metric_id, CAST(month AS DATE) AS month FROM nation, (VALUES ('1a'), ('2'), ('5a')) v(metric_id),
 (SELECT unnest(generate_series(DATE '2019-04-01', DATE '2020-03-01', INTERVAL 1 MONTH)) AS month) m""")
def template_cross(spark, path):
    nation = src(spark, path).table("nation").select("n_name")
    return joins.template(nation, ["1a", "2", "5a"], "2019-04-01", "2020-03-01")


@query("full_outer_month", """SELECT coalesce(a.month, b.month) AS month, placed, shipped FROM
 (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS placed FROM orders GROUP BY 1) a
 FULL JOIN (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS shipped FROM lineitem GROUP BY 1) b ON a.month = b.month""")
def full_outer_month(spark, path):
    s = src(spark, path)
    a = s.table("orders").groupBy(dates.month_start(F.col("o_orderdate").cast("date")).alias("month")).agg(F.count(F.lit(1)).alias("placed"))
    b = s.table("lineitem").groupBy(dates.month_start(F.col("l_shipdate").cast("date")).alias("month")).agg(F.count(F.lit(1)).alias("shipped"))
    return a.join(b, "month", "full")


@query("semi_join_members", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def semi_join_members(spark, path):
    s = src(spark, path)
    placed = s.table("orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return select.members(s.table("customer").select("c_custkey", "c_name"), placed, "c_custkey")


@query("anti_join_members", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def anti_join_members(spark, path):
    s = src(spark, path)
    placed = s.table("orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return select.non_members(s.table("customer").select("c_custkey", "c_name"), placed, "c_custkey")


@query("nearest_event_interval", """SELECT DISTINCT TUMOUR_AVP_ID, TUMOUR_ID, CAST(days_difference AS INTEGER) AS days_difference FROM (SELECT r.TUMOUR_AVP_ID, e.TUMOUR_ID, abs(datediff('day', DIAGNOSISDATE, EVENT_DATE)) AS days_difference,
 rank() OVER (PARTITION BY r.TUMOUR_AVP_ID ORDER BY abs(datediff('day', DIAGNOSISDATE, EVENT_DATE))) AS rk
 FROM fx_rapid r JOIN fx_pathway e ON r.ParticipantID = e.ParticipantID AND e.EVENT_TYPE IN (6, 100) AND abs(datediff('day', DIAGNOSISDATE, EVENT_DATE)) <= 15) WHERE rk = 1""")
def nearest_event_interval(spark, path):
    s = src(spark, path)
    return diagnoses.link_rapid(s.fx("fx_rapid"), s.fx("fx_pathway"))


GROUP = "CASE {0} WHEN 'C34' THEN 'Lung' WHEN 'C50' THEN 'Breast' WHEN 'C61' THEN 'Urological' WHEN 'D09' THEN 'Urological' WHEN 'C76' THEN '{1}' END"


@query("nearest_event_group", f"""SELECT DISTINCT TUMOUR_AVP_ID, TUMOUR_ID, CAST(days_difference AS INTEGER) AS days_difference FROM (SELECT r.TUMOUR_AVP_ID, e.TUMOUR_ID, abs(datediff('day', DIAGNOSISDATE, DIAGNOSISDATEBEST)) AS days_difference,
 rank() OVER (PARTITION BY r.TUMOUR_AVP_ID ORDER BY abs(datediff('day', DIAGNOSISDATE, DIAGNOSISDATEBEST))) AS rk
 FROM (SELECT *, {GROUP.format('TUMOUR_SITE', 'Unknown')} AS g FROM fx_rapid) r JOIN (SELECT *, {GROUP.format('SITE_ICD10_3CHAR', 'Other')} AS g FROM fx_registry) e
 ON r.ParticipantID = e.ParticipantID AND r.g = e.g AND abs(datediff('day', DIAGNOSISDATE, DIAGNOSISDATEBEST)) <= 90) WHERE rk = 1""")
def nearest_event_group(spark, path):
    s = src(spark, path)
    groups = diagnoses.icd_groups(views.site_codes(spark))
    return diagnoses.link_rapid_by_group(diagnoses.site_group(s.fx("fx_rapid"), "TUMOUR_SITE", groups, False),
                                         diagnoses.site_group(s.fx("fx_registry"), "SITE_ICD10_3CHAR", groups, True))


@query("asof_prior_event", """SELECT outcome_id, event_id, CAST(days AS INTEGER) AS days_diff FROM (SELECT o.event_id AS outcome_id, e.event_id, datediff('day', e.d, o.d) AS days,
 row_number() OVER (PARTITION BY o.event_id ORDER BY datediff('day', e.d, o.d), e.ord, e.event_id) AS rn
 FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS d FROM events WHERE event_type = 'purchase') o
 JOIN (SELECT event_id, user_id, CAST(ts AS DATE) AS d, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 ELSE 3 END AS ord FROM events WHERE event_type IN ('signup','view','click')) e
 ON o.user_id = e.user_id AND e.d <= o.d) WHERE rn = 1""")
def asof_prior_event(spark, path):
    ev = src(spark, path).table("events").select("event_id", "user_id", "event_type", F.col("ts").cast("date").alias("d"))
    outcomes = ev.filter("event_type = 'purchase'").select(F.col("event_id").alias("outcome_id"), "user_id", F.col("d").alias("outcome_date"))
    before = ev.filter(F.col("event_type").isin("signup", "view", "click"))
    order = F.when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "view", 2).otherwise(3)
    return joins.prior_event(before, outcomes, "user_id", "event_id", "d", order, "outcome_id", "outcome_date")


@query("fuzzy_match_terms", """SELECT p_partkey, p_name, term, dist AS distance FROM part JOIN (SELECT token, term, dist FROM (SELECT token, term, round(1 - jaro_similarity(token, term), 9) AS dist,
 rank() OVER (PARTITION BY token ORDER BY round(1 - jaro_similarity(token, term), 9)) AS rk FROM (SELECT DISTINCT p_name AS token FROM part) t,
 (VALUES ('small ring'), ('red widget'), ('blue bolt'), ('hot gear'), ('old gizmo'), ('cold spring')) v(term)) WHERE rk = 1) b ON p_name = token""")
def fuzzy_match_terms(spark, path):
    return joins.closest_terms(src(spark, path).table("part").select("p_partkey", "p_name"), "p_name", PART_TERMS).select(
        "p_partkey", "p_name", "term", "distance")


@query("two_stage_code_lookup", f"""SELECT TUMOUR_ID, SITE_ICD10_3CHAR AS code, {GROUP.format('SITE_ICD10_3CHAR', 'Other')} AS tumour_site_group FROM fx_registry""")
def two_stage_code_lookup(spark, path):
    groups = diagnoses.icd_groups(views.site_codes(spark))
    return diagnoses.site_group(src(spark, path).fx("fx_registry"), "SITE_ICD10_3CHAR", groups, True).select(
        "TUMOUR_ID", F.col("SITE_ICD10_3CHAR").alias("code"), "tumour_site_group")


ADJ = """SELECT project, CAST(date_trunc('month', month) AS DATE) AS month, metric_id, max(numerator) AS adj FROM fx_adjustments WHERE active = 'TRUE' AND date_removed IS NULL GROUP BY 1, 2, 3"""


def adjustments(spark, path):
    rows = reports.active_adjustments(src(spark, path).fx("fx_adjustments"))
    return rows.groupBy("project", "month", "metric_id").agg(F.max("adjusted_numerator").alias("adjusted_numerator"))


@query("adjustment_overlay", f"""SELECT m.project, m.month, m.metric_id, coalesce(adj, numerator) AS numerator,
 CASE WHEN adj IS NOT NULL THEN 'Manual adjustment, original data was ' || coalesce(CAST(numerator AS VARCHAR), 'NA') END AS comment
FROM fx_metric_rows m LEFT JOIN ({ADJ}) a ON m.project = a.project AND m.month = a.month AND m.metric_id = a.metric_id""")
def adjustment_overlay(spark, path):
    rows = src(spark, path).fx("fx_metric_rows").drop("metric_name")
    return joins.overlay(rows, adjustments(spark, path), ["project", "month", "metric_id"], "numerator", "adjusted_numerator").select(
        "project", "month", "metric_id", "numerator", "comment")


SHARE = "SELECT o_orderpriority, count(*) AS n, round(1.0 * count(*) / (SELECT count(*) FROM orders {0}), 4) AS p FROM orders {0} GROUP BY 1"


@query("filtered_vs_all", f"""SELECT a.o_orderpriority, a.n AS all_n, a.p AS all_p, f.n AS filtered_n, f.p AS filtered_p, round(f.p - a.p, 4) AS difference_p
FROM ({SHARE.format('')}) a LEFT JOIN ({SHARE.format("WHERE o_orderstatus = 'F'")}) f ON a.o_orderpriority = f.o_orderpriority""")
def filtered_vs_all(spark, path):
    orders = src(spark, path).table("orders")
    def shares(df):
        total = df.select(F.count(F.lit(1))).scalar()
        return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).withColumn("p", F.round(F.col("n") / total, 4))
    return joins.filtered_versus_all(shares(orders), shares(orders.filter("o_orderstatus = 'F'")), "o_orderpriority", "p")
