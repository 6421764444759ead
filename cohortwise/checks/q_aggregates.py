"""Queries on aggregates, ordered history, set operations and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.checks import cohort_views as views
from cohortwise.checks.q_select import FY, LINES, lines, src
from cohortwise.checks.registry import query
from cohortwise.checks.sql_parts import complete_months
from cohortwise.functions import clean, dates
from cohortwise.operators import aggregate, joins, reshape, select, windows
from cohortwise.plans import reports, tables

M = "CAST(date_trunc('month', {0}) AS DATE)"


# --- aggregates

@query("metric_standard", f"""SELECT o_custkey % 6 AS project, {M.format('o_orderdate')} AS month, o_orderpriority AS metric_id, count(DISTINCT o_custkey) AS numerator FROM orders GROUP BY 1, 2, 3""")
def metric_standard(spark, path):
    rows = src(spark, path).table("orders").select(
        (F.col("o_custkey") % 6).alias("project"), dates.month_start(F.col("o_orderdate").cast("date")).alias("month"),
        F.col("o_orderpriority").alias("metric_id"), "o_custkey")
    return aggregate.distinct_people(rows, ["project", "month", "metric_id"], "o_custkey")


@query("metric_median", f"""SELECT o_custkey % 6 AS project, {M.format('l_shipdate')} AS month, CAST(median(datediff('day', o_orderdate, l_shipdate)) AS DOUBLE) AS numerator
FROM {LINES} WHERE l_shipdate >= o_orderdate GROUP BY 1, 2""")
def metric_median(spark, path):
    rows = lines(spark, path).filter(F.col("ship") >= F.col("placed")).select(
        (F.col("o_custkey") % 6).alias("project"), dates.month_start("ship").alias("month"), dates.days_between("placed", "ship").alias("days"))
    return aggregate.median_days(rows, ["project", "month"], "days")


CUBE = """(SELECT l_returnflag, l_linestatus, l_linenumber, CAST(l_quantity AS BIGINT) AS w, l_discount, l_tax FROM lineitem)"""


def weighted_lines(spark, path):
    return src(spark, path).table("lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", F.col("l_quantity").cast("bigint").alias("w"),
                                                     "l_discount", "l_tax")


@query("conditional_sums", f"""SELECT l_linenumber, CAST(sum(CASE WHEN l_returnflag = 'A' THEN w ELSE 0 END) AS BIGINT) AS a, CAST(sum(CASE WHEN l_returnflag = 'R' THEN w ELSE 0 END) AS BIGINT) AS r,
 CAST(sum(CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN w ELSE 0 END) AS BIGINT) AS a_open, CAST(sum(CASE WHEN l_discount > 0.05 THEN w ELSE 0 END) AS BIGINT) AS discounted,
 round(sum(CASE WHEN l_returnflag = 'A' THEN w ELSE 0 END) / nullif(CAST(sum(CASE WHEN l_returnflag = 'R' THEN w ELSE 0 END) AS DOUBLE), 0), 4) AS a_per_r FROM {CUBE} GROUP BY 1""")
def conditional_sums(spark, path):
    a, r = F.col("l_returnflag") == "A", F.col("l_returnflag") == "R"
    return aggregate.conditional_sums(weighted_lines(spark, path), ["l_linenumber"], "w", {
        "a": a, "r": r, "a_open": a & (F.col("l_linestatus") == "O"), "discounted": F.col("l_discount") > 0.05,
    }).withColumn("a_per_r", clean.ratio("a", "r"))


@query("share_of_total", f"""SELECT l_returnflag AS response, CAST(sum(w) AS BIGINT) AS n, round(100.0 * CAST(sum(w) AS DOUBLE) / (SELECT CAST(sum(w) AS DOUBLE) FROM {CUBE}), 1) AS n_perc, 'flag' AS milestone FROM {CUBE} GROUP BY 1""")
def share_of_total(spark, path):
    return aggregate.share_of_total(weighted_lines(spark, path), "l_returnflag", "w", "flag")


@query("milestone_efficiency", " UNION ALL ".join(
    f"SELECT '{m}' AS milestone, CAST({c} AS VARCHAR) AS response, CAST(sum(w) AS BIGINT) AS n, round(100.0 * CAST(sum(w) AS DOUBLE) / (SELECT CAST(sum(w) AS DOUBLE) FROM {CUBE}), 1) AS n_perc FROM {CUBE} GROUP BY 2"
    for m, c in [("flag", "l_returnflag"), ("status", "l_linestatus"), ("line", "l_linenumber"),
                 ("scan", "CASE WHEN l_tax > 0.04 THEN 'Scanned' ELSE 'No scan' END")]))
def milestone_efficiency(spark, path):
    return aggregate.milestone_shares(weighted_lines(spark, path), "w", {
        "flag": F.col("l_returnflag"), "status": F.col("l_linestatus"), "line": F.col("l_linenumber"),
        "scan": F.when(F.col("l_tax") > 0.04, "Scanned").otherwise("No scan")})


@query("conversion_rates", " UNION ALL ".join(
    f"SELECT '{n}' AS segment, CAST(sum(CASE WHEN l_returnflag <> 'R' THEN w ELSE 0 END) AS BIGINT) AS base, CAST(sum(CASE WHEN l_returnflag = 'A' THEN w ELSE 0 END) AS BIGINT) AS hit, "
    f"round(CAST(sum(CASE WHEN l_returnflag = 'A' THEN w ELSE 0 END) AS DOUBLE) / CAST(sum(CASE WHEN l_returnflag <> 'R' THEN w ELSE 0 END) AS DOUBLE), 4) AS conversion FROM {CUBE} WHERE {c}"
    for n, c in [("all", "TRUE"), ("open", "l_linestatus = 'O'"), ("closed", "l_linestatus = 'F'"), ("first", "l_linenumber = 1"), ("open first", "l_linestatus = 'O' AND l_linenumber = 1")]))
def conversion_rates(spark, path):
    is_open, first = F.col("l_linestatus") == "O", F.col("l_linenumber") == 1
    return aggregate.segment_ratios(
        weighted_lines(spark, path),
        {"all": F.lit(True), "open": is_open, "closed": F.col("l_linestatus") == "F", "first": first, "open first": is_open & first},
        "w", F.col("l_returnflag") != "R", F.col("l_returnflag") == "A")


@query("preaggregate_cube", "SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS yr, count(DISTINCT o_custkey) AS participants FROM orders GROUP BY 1, 2, 3")
def preaggregate_cube(spark, path):
    return aggregate.collapse_person(src(spark, path).table("orders").select("o_custkey", "o_orderstatus", "o_orderpriority", F.year("o_orderdate").alias("yr")), "o_custkey")


@query("weighted_count", f"SELECT l_returnflag, l_linestatus, CAST(sum(w) AS BIGINT) AS n FROM {CUBE} GROUP BY 1, 2")
def weighted_count(spark, path):
    return weighted_lines(spark, path).groupBy("l_returnflag", "l_linestatus").agg(F.sum("w").alias("n"))


@query("metric_by_fin_year", f"""SELECT metric_id, {FY.format('month')} AS financial_year, CASE WHEN metric_id IN ('10','11','12','13') THEN NULL ELSE coalesce(sum(numerator), 0) END AS numerator FROM rows_h GROUP BY 1, 2""")
def metric_by_fin_year(spark, path):
    rows = reports.harmonise_ids(src(spark, path).fx("fx_metric_rows")).withColumn("financial_year", dates.financial_year("month"))
    return rows.groupBy("metric_id", "financial_year").agg(F.coalesce(F.sum("numerator"), F.lit(0.0)).alias("_n")).select(
        "metric_id", "financial_year", F.when(~F.col("metric_id").isin(aggregate.MEDIAN_METRICS), F.col("_n")).alias("numerator"))


@query("sum_or_median", """SELECT s.metric_id, s.project, CASE WHEN s.metric_id IN ('10','11') THEN CASE WHEN missing = 0 THEN med END ELSE CASE WHEN missing = 0 THEN total END END AS strict_value,
 CASE WHEN s.metric_id IN ('10','11') THEN med ELSE coalesce(total, 0) END AS lenient_value
FROM (SELECT metric_id, project, sum(numerator) AS total, median(numerator) AS med, count(*) FILTER (numerator IS NULL) AS missing FROM rows_h GROUP BY 1, 2) s""")
def sum_or_median(spark, path):
    rows = reports.harmonise_ids(src(spark, path).fx("fx_metric_rows"))
    by = ["metric_id", "project"]
    strict = aggregate.sum_or_median(rows, by, strict=True).withColumnRenamed("numerator", "strict_value")
    return joins.null_safe(strict, aggregate.sum_or_median(rows, by).withColumnRenamed("numerator", "lenient_value"), by, "inner")


@query("grouping_subtotals", """SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'Total' ELSE c_mktsegment END AS segment, CASE WHEN grouping(nation) = 1 THEN 'Total' ELSE nation END AS nation,
 CAST(sum(n) AS BIGINT) AS n FROM (SELECT c_mktsegment, CAST(c_nationkey AS VARCHAR) AS nation, count(*) AS n FROM customer GROUP BY 1, 2) GROUP BY ROLLUP (c_mktsegment, nation)""")
def grouping_subtotals(spark, path):
    counts = src(spark, path).table("customer").groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").cast("string").alias("nation")).agg(
        F.count(F.lit(1)).alias("n"))
    return aggregate.subtotals(counts, ["segment", "nation"], "n")


STATUS = ["F", "O", "P"]
WIDE = "SELECT o_orderpriority, count(DISTINCT CASE WHEN o_orderstatus = 'F' THEN o_custkey END) AS F, count(DISTINCT CASE WHEN o_orderstatus = 'O' THEN o_custkey END) AS O, count(DISTINCT CASE WHEN o_orderstatus = 'P' THEN o_custkey END) AS P FROM orders GROUP BY 1"


@query("pivot_with_totals", f"SELECT o_orderpriority, F, O, P, F + O + P AS Total FROM ({WIDE}) UNION ALL SELECT 'Total', CAST(sum(F) AS BIGINT), CAST(sum(O) AS BIGINT), CAST(sum(P) AS BIGINT), CAST(sum(F + O + P) AS BIGINT) FROM ({WIDE})")
def pivot_with_totals(spark, path):
    return aggregate.pivot_with_totals(src(spark, path).table("orders"), "o_orderpriority", "o_orderstatus", STATUS, F.countDistinct("o_custkey"))


STEPS = [("all", "TRUE"), ("urgent", "o_orderpriority = '1-URGENT'"), ("finished", "o_orderstatus = 'F'"), ("large", "o_totalprice > 250000")]


@query("funnel_counts", "SELECT step_no, step, people, round(100.0 * people / max(CASE WHEN step_no = 1 THEN people END) OVER (), 2) AS perc FROM (" + " UNION ALL ".join(
    f"SELECT {i} AS step_no, '{n}' AS step, count(DISTINCT o_custkey) AS people FROM orders WHERE " + " AND ".join(c for _, c in STEPS[:i])
    for i, (n, _) in enumerate(STEPS, 1)) + ")")
def funnel_counts(spark, path):
    return aggregate.flag_funnel(src(spark, path).table("orders"), {
        "all": F.lit(True), "urgent": F.col("o_orderpriority") == "1-URGENT", "finished": F.col("o_orderstatus") == "F",
        "large": F.col("o_totalprice") > 250000}, "o_custkey")


PROFILED = [*[(c, "string") for c in ("ParticipantID", "SubmittedZipFile", "SubmittedFile", "UserEmail", "Age", "Sex", "LSOA", "Ethnicity", "Marital_Status", "Language", "CCG_Code")],
            ("TransactionId", "bigint"), ("CSURowNumber", "bigint"), ("ReceivedDate", "date")]


@query("profile_columns", " UNION ALL ".join(
    f"SELECT '{c}' AS variable, '{t}' AS class, count(*) AS rows, count(*) FILTER (v IS NULL) AS missing, count(DISTINCT v) AS cardinality, "
    f"round(1.0 * count(*) FILTER (v IS NULL) / count(*), 6) AS missing_rate, round(1.0 * count(DISTINCT v) / count(*), 6) AS cardinality_rate "
    f"FROM (SELECT CASE WHEN CAST({c} AS VARCHAR) NOT IN ('', 'NULL', 'null', 'Null') THEN {c} END AS v FROM fx_demographics)" for c, t in PROFILED))
def profile_columns(spark, path):
    df = clean.junk_to_null(src(spark, path).fx("fx_demographics"))
    return aggregate.profile(df, skip_prefix="calc_")


@query("list_and_mode", """SELECT o_custkey, string_agg(o_orderpriority, ', ' ORDER BY o_orderpriority) AS values_list, first(o_orderpriority ORDER BY n DESC, o_orderpriority) AS mode
FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2) GROUP BY 1""")
def list_and_mode(spark, path):
    return aggregate.list_and_mode(src(spark, path).table("orders"), "o_custkey", "o_orderpriority")


@query("new_data_flag", """SELECT g.project, g.last_month = (SELECT max(month) FROM fx_metric_rows) AS new_data FROM (SELECT project, max(month) AS last_month FROM
 (SELECT project, month, sum(numerator) AS t FROM fx_metric_rows GROUP BY 1, 2) WHERE t > 0 GROUP BY 1) g""")
def new_data_flag(spark, path):
    return aggregate.new_data_flag(src(spark, path).fx("fx_metric_rows"), "project")


@query("demographic_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS attribute, project, CAST({s} AS VARCHAR) AS value, count(DISTINCT ParticipantID) AS people FROM b_invites GROUP BY 2, 3"
    for c, s in [("sex", "sex_c"), ("age", "age_band_five"), ("imd", "coalesce(CAST(imd_decile AS VARCHAR), 'Not known')"), ("ethnicity", "ethnic_group")]))
def demographic_counts(spark, path):
    inv = views.cohort(spark, path).invites.withColumn("metric_id", F.lit("1a"))
    cells = F.array(*[F.struct(F.lit(n).alias("attribute"), v.alias("value")) for n, v in [
        ("sex", F.col("sex")), ("age", F.col("age_band_five")), ("imd", F.coalesce(F.col("imd_decile").cast("string"), F.lit("Not known"))),
        ("ethnicity", F.col("ethnic_group"))]])
    return (inv.select("ParticipantID", "project", F.explode(cells).alias("_c")).groupBy("_c.attribute", "project", "_c.value")
            .agg(F.countDistinct("ParticipantID").alias("people")))


@query("header_combinations", f"SELECT DISTINCT o_orderstatus, o_orderpriority, {M.format('o_orderdate')} AS month FROM orders")
def header_combinations(spark, path):
    return src(spark, path).table("orders").select("o_orderstatus", "o_orderpriority", dates.month_start(F.col("o_orderdate").cast("date")).alias("month")).distinct()


# --- ordered history

@query("scan_sequence", "SELECT ParticipantID, scan_d AS scan_date, CAST(seq AS INTEGER) AS sequence FROM seq_scan")
def scan_sequence(spark, path):
    return windows.sequence_dates(views.cohort(spark, path).clean_scans, "ParticipantID", "scan_date").select("ParticipantID", "scan_date", "sequence")


@query("scan_category", "SELECT ParticipantID, LDCT_Date, CSURowNumber, CAST(days_first AS INTEGER) AS days_from_first, category AS scan_category FROM cl_scan")
def scan_category(spark, path):
    return views.cohort(spark, path).clean_scans.select("ParticipantID", "LDCT_Date", "CSURowNumber", "days_from_first", "scan_category")


@query("lag_previous", f"""SELECT o_custkey, day, previous, CAST({complete_months('previous', 'day')} AS INTEGER) AS months FROM (SELECT o_custkey, day, lag(day) OVER (PARTITION BY o_custkey ORDER BY day) AS previous
 FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders))""")
def lag_previous(spark, path):
    rows = src(spark, path).table("orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return windows.sequence_dates(rows, "o_custkey", "day").select("o_custkey", "day", "previous", dates.complete_months("previous", "day").alias("months"))


@query("scan_pathway", f"""SELECT c.ParticipantID, c.LDCT_Date, c.CSURowNumber, c.scan_d AS scan_date, c.moved AS report_date_used, CAST(c.days_first AS INTEGER) AS days_from_first,
 c.category AS scan_category, CAST(s.seq AS INTEGER) AS sequence, CAST({complete_months('c.first_d', 'c.scan_d')} AS INTEGER) AS months_from_first, CAST({complete_months('s.prev_d', 's.scan_d')} AS INTEGER) AS months_from_previous
FROM cl_scan c LEFT JOIN seq_scan s ON c.ParticipantID = s.ParticipantID AND c.scan_d = s.scan_d""")
def scan_pathway(spark, path):
    return tables.sequence_scans(views.cohort(spark, path).clean_scans).select(
        "ParticipantID", "LDCT_Date", "CSURowNumber", "scan_date", "report_date_used", "days_from_first", "scan_category", "sequence",
        "months_from_first", "months_from_previous")


@query("rank_ties", "SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate) DESC) AS rk FROM orders) WHERE rk = 1")
def rank_ties(spark, path):
    month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
    return select.ranked_first(src(spark, path).table("orders"), ["o_custkey"], [month.desc()]).select("o_custkey", "o_orderkey")


@query("window_person_summary", """SELECT user_id, count(*) AS contacts, CAST(min(CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 ELSE 3 END) AS INTEGER) AS best_rank,
 CAST(max(ts) AS DATE) AS last_date, array_to_string(list_sort(list(DISTINCT event_type)), ', ') AS methods FROM events GROUP BY 1""")
def window_person_summary(spark, path):
    rank = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "click", 2).otherwise(3)
    rows = src(spark, path).table("events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type", rank.alias("rank"))
    return windows.person_contacts(rows, "user_id", "day", "event_type", "rank")


@query("add_count", "SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type) AS n FROM events")
def add_count(spark, path):
    return windows.add_count(src(spark, path).table("events").select("event_id", "user_id", "event_type"), ["user_id", "event_type"]).select("event_id", "n")


@query("event_run_id", """SELECT user_id, day, event_type, CAST(user_id AS VARCHAR) || '#' || CAST(row_number() OVER (PARTITION BY user_id ORDER BY day, event_type) AS VARCHAR) AS event_key
FROM (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day, event_type FROM events)""")
def event_run_id(spark, path):
    rows = src(spark, path).table("events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    return windows.event_run_id(rows, "user_id", "day", "event_type").drop("run")


# --- sorts, sets, shapes

@query("ordered_report", "SELECT project, month, metric_id, numerator FROM rows_h")
def ordered_report(spark, path):
    rows = reports.harmonise_ids(src(spark, path).fx("fx_metric_rows")).select("project", "month", "metric_id", "numerator")
    return rows.orderBy("project", F.desc("month"), reports._metric_order())


@query("union_by_name", """SELECT c_custkey AS id, c_name AS name, NULL AS amount, 'customer' AS source FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""")
def union_by_name(spark, path):
    s = src(spark, path)
    return reshape.union_all([
        s.table("customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("customer").alias("source")),
        s.table("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("amount"), F.lit("supplier").alias("source")),
    ]).select("id", "name", "amount", "source")


TABLES = [("Demographics", "demographics"), ("Invites", "invite"), ("LHC", "check"), ("Measurements", "measurement"), ("Other History", "history"),
          ("LDCT", "scan"), ("Diagnostics", "diagnostics"), ("Smoking", "smoking")]


@query("submission_history", " UNION ALL ".join(
    f"SELECT DISTINCT '{n}' AS table_name, TransactionId, ReceivedDate, UserEmail FROM fx_{v} WHERE substr(SubmittedZipFile, 1, 5) = 'ORG02'" for n, v in TABLES))
def submission_history(spark, path):
    s = src(spark, path)
    return reshape.union_all([
        s.fx(f"fx_{v}").filter(F.substring("SubmittedZipFile", 1, 5) == "ORG02").select(F.lit(n).alias("table_name"), "TransactionId", "ReceivedDate", "UserEmail").distinct()
        for n, v in TABLES])


@query("set_difference", "SELECT n_name FROM nation EXCEPT SELECT n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey WHERE s_acctbal > 5000")
def set_difference(spark, path):
    s = src(spark, path)
    nation = s.table("nation")
    rich = s.table("supplier").filter("s_acctbal > 5000").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("n_name")
    return reshape.set_difference(nation.select("n_name"), rich)


@query("union_distinct", "SELECT o_custkey AS id FROM orders UNION SELECT user_id FROM events")
def union_distinct(spark, path):
    s = src(spark, path)
    return reshape.union_all([s.table("orders").select(F.col("o_custkey").alias("id")), s.table("events").select(F.col("user_id").alias("id"))]).distinct()


@query("unpivot_dates", """SELECT ParticipantID, 'first_letter' AS event, first_letter_d AS date FROM cl_invite WHERE first_letter_d IS NOT NULL UNION ALL
SELECT ParticipantID, 'second_letter', second_letter_d FROM cl_invite WHERE second_letter_d IS NOT NULL UNION ALL SELECT ParticipantID, 'call', call_d FROM cl_invite WHERE call_d IS NOT NULL""")
def unpivot_dates(spark, path):
    inv = views.cohort(spark, path).clean_invites.select("ParticipantID", F.col("first_letter_date").alias("first_letter"),
                                                         F.col("second_letter_date").alias("second_letter"), F.col("follow_up_call_date").alias("call"))
    return reshape.to_long(inv, ["ParticipantID"], ["first_letter", "second_letter", "call"], "event", "date")


MONTHS = [f"{y}-{m:02d}-01" for y in range(2019, 2027) for m in range(1, 13)]
YEARS = ["2018-19", "2019-20", "2020-21", "2021-22", "2022-23", "2023-24", "2024-25", "2025-26"]


@query("pivot_month", "SELECT project, " + ", ".join(f"sum(numerator) FILTER (month = DATE '{m}') AS m_{m[:7].replace('-', '_')}" for m in MONTHS) + " FROM fx_metric_rows GROUP BY 1")
def pivot_month(spark, path):
    rows = src(spark, path).fx("fx_metric_rows").withColumn("label", F.date_format("month", "yyyy_MM"))
    return reshape.to_wide(rows, ["project"], "label", [m[:7].replace("-", "_") for m in MONTHS], F.sum("numerator"), prefix="m_")


@query("pivot_fin_year", "SELECT metric_id, " + ", ".join(f"coalesce(sum(numerator) FILTER (fy = '{y}'), 0) AS fy_{y.replace('-', '_')}" for y in YEARS)
       + f" FROM (SELECT *, {FY.format('month')} AS fy FROM rows_h) GROUP BY 1")
def pivot_fin_year(spark, path):
    rows = reports.harmonise_ids(src(spark, path).fx("fx_metric_rows")).withColumn("fy", F.translate(dates.financial_year("month"), "-", "_"))
    return reshape.to_wide(rows, ["metric_id"], "fy", [y.replace("-", "_") for y in YEARS], F.sum("numerator"), fill=0.0, prefix="fy_")


@query("pivot_tables", "SELECT TransactionId, " + ", ".join(f"max(ReceivedDate) FILTER (t = '{v}') AS t_{v}" for _, v in TABLES) + " FROM ("
       + " UNION ALL ".join(f"SELECT TransactionId, ReceivedDate, '{v}' AS t FROM fx_{v}" for _, v in TABLES) + ") GROUP BY 1")
def pivot_tables(spark, path):
    s = src(spark, path)
    rows = reshape.union_all([s.fx(f"fx_{v}").select("TransactionId", "ReceivedDate", F.lit(v).alias("t")) for _, v in TABLES])
    return reshape.to_wide(rows, ["TransactionId"], "t", [v for _, v in TABLES], F.max("ReceivedDate"), prefix="t_")


@query("complete_combinations", f"""SELECT h.project, h.month, v.metric_id, coalesce(m.numerator, 0) AS numerator FROM (SELECT DISTINCT project, month FROM fx_metric_rows) h
CROSS JOIN (SELECT DISTINCT metric_id FROM fx_metric_rows) v LEFT JOIN fx_metric_rows m ON h.project IS NOT DISTINCT FROM m.project AND h.month = m.month AND v.metric_id = m.metric_id""")
def complete_combinations(spark, path):
    return reshape.complete(src(spark, path).fx("fx_metric_rows"), ["project", "month"], ["metric_id"], "numerator", fill=0.0)


@query("month_calendar", f"""SELECT project, CAST(unnest(generate_series(first_month, last_month, INTERVAL 1 MONTH)) AS DATE) AS month
FROM (SELECT project, min(month) AS first_month, max(month) AS last_month FROM fx_metric_rows GROUP BY 1)""")
def month_calendar(spark, path):
    spans = src(spark, path).fx("fx_metric_rows").groupBy("project").agg(F.min("month").alias("a"), F.max("month").alias("b"))
    return spans.select("project", F.explode(reshape.months(F.col("b"), F.col("a"))).alias("month"))


@query("uncount_rows", "SELECT l_orderkey, l_linenumber, l_returnflag FROM (SELECT l_orderkey, l_linenumber, l_returnflag, unnest(generate_series(1, CAST(l_quantity AS BIGINT) % 4)) AS i FROM lineitem)")
def uncount_rows(spark, path):
    rows = src(spark, path).table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", (F.col("l_quantity").cast("bigint") % 4).alias("w"))
    return reshape.uncount(rows, "w")


@query("fill_defaults", "SELECT ParticipantID, coalesce(Marital_Status, 'Exclude') AS Marital_Status, coalesce(Age, '0') AS Age FROM fx_demographics")
def fill_defaults(spark, path):
    return reshape.fill_defaults(src(spark, path).fx("fx_demographics").select("ParticipantID", "Marital_Status", "Age"), {"Marital_Status": "Exclude", "Age": "0"})


@query("select_by_type", "SELECT ParticipantID, first_letter_d AS first_letter_date, second_letter_d AS second_letter_date, call_d AS follow_up_call_date, contact_d AS contact_date, outcome_d AS outcome_date FROM cl_invite")
def select_by_type(spark, path):
    inv = views.cohort(spark, path).clean_invites
    months = [c for c in inv.columns if c.endswith("_month")]
    return reshape.select_by_type(inv.drop(*months, "ReceivedDate"), T.DateType, ["ParticipantID"])
