"""Queries on report tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.checks import cohort_views as views
from cohortwise.checks.q_joins import ADJ, adjustments
from cohortwise.checks.q_select import FY, src
from cohortwise.checks.registry import query
from cohortwise.checks.sql_parts import E, records
from cohortwise.functions import dates
from cohortwise.operators import joins, reshape
from cohortwise.plans import metrics, reports, vocab


def rows(spark, path):
    return reports.harmonise_ids(src(spark, path).fx("fx_metric_rows")).drop("metric_name")


MED = "('10','11','12','13')"
# All months and financial years of the given orders, written out apart from the plans.
SPAN = ("2019-01-01", "2026-03-01")
MONTHS = [f"{y}-{m:02d}-01" for y in range(2019, 2027) for m in range(1, 13) if (y, m) <= (2026, 3)]
YEARS = ["2018-19", "2019-20", "2020-21", "2021-22", "2022-23", "2023-24", "2024-25", "2025-26"]


def metric_table_sql(group: str, frame: str, strict: bool) -> str:
    value = (f"CASE WHEN missing = 0 THEN CASE WHEN metric_id IN {MED} THEN med ELSE s END END" if strict
             else f"CASE WHEN metric_id IN {MED} THEN med ELSE coalesce(s, 0) END")
    years = ", ".join(f"CASE WHEN metric_id NOT IN {MED} THEN coalesce(sum(s) FILTER (fy = '{y}'), 0) END AS fy_{y.replace('-', '_')}" for y in YEARS)
    months = ", ".join(f"max(v) FILTER (month = DATE '{m}') AS m_{m[:7].replace('-', '_')}" for m in MONTHS)
    head, by = (f"{group}, ", f"{group}, metric_id") if group else ("", "metric_id")
    zeros, blanks = ", ".join("0.0" for _ in YEARS), ", ".join("NULL" for _ in MONTHS)
    people = f"SELECT {head}'1b', 'People', CAST(sum(eligible_population) AS DOUBLE), {zeros}, {blanks} FROM fx_projects" + (f" GROUP BY {group}" if group else "")
    return f"""SELECT {head}metric_id, CASE WHEN metric_id IN {MED} THEN 'Days' ELSE 'People' END AS unit,
 CASE WHEN metric_id NOT IN {MED} THEN coalesce(sum(s), 0) END AS total, {years}, {months}
FROM (SELECT *, {value} AS v FROM (SELECT {head}metric_id, month, {FY.format('month')} AS fy, sum(numerator) AS s, median(numerator) AS med,
 count(*) FILTER (numerator IS NULL) AS missing FROM {frame} GROUP BY ALL)) GROUP BY {by} UNION ALL {people}"""


@query("metric_table", metric_table_sql("project", "rows_h", True))
def metric_table(spark, path):
    return reports.metric_table(rows(spark, path), ["project"], True, *SPAN, src(spark, path).fx("fx_projects"))


@query("metric_table_national", metric_table_sql("", "rows_h", False))
def metric_table_national(spark, path):
    return reports.metric_table(rows(spark, path), [], False, *SPAN, src(spark, path).fx("fx_projects"))


@query("metric_table_phase", metric_table_sql("phase", "(SELECT r.*, p.phase FROM rows_h r LEFT JOIN fx_projects p ON r.project = p.project)", False))
def metric_table_phase(spark, path):
    phased = joins.lookup(rows(spark, path), src(spark, path).fx("fx_projects"), "project", ["phase"])
    return reports.metric_table(phased, ["phase"], False, *SPAN, src(spark, path).fx("fx_projects"))


def s_of(ids: str, name: str) -> str:
    return f"sum(CASE WHEN metric_id IN ({ids}) THEN coalesce(numerator, 0) END) AS {name}"


CONTENT = f"""SELECT p.project, p.phase, strftime(p.start_date, '%b %Y') AS start, p.eligible_population, invited, attended, scans, cancers, new_data FROM fx_projects p
LEFT JOIN (SELECT project, {s_of("'1a'", 'invited')}, {s_of("'3a','3b'", 'attended')}, {s_of("'5a'", 'scans')}, {s_of("'6a','6b','6c','6d'", 'cancers')} FROM rows_h GROUP BY 1) s ON p.project = s.project
LEFT JOIN (SELECT project, max(month) = (SELECT max(month) FROM rows_h) AS new_data FROM (SELECT project, month, sum(numerator) AS t FROM rows_h GROUP BY 1, 2) WHERE t > 0 GROUP BY 1) n ON p.project = n.project"""


@query("contents_table", f"""SELECT *, round(attended / nullif(invited, 0), 4) AS uptake FROM ({CONTENT}
UNION ALL SELECT 'Total', NULL, NULL, CAST(sum(eligible_population) AS BIGINT), sum(invited), sum(attended), sum(scans), sum(cancers), NULL FROM ({CONTENT}))""")
def contents_table(spark, path):
    return reports.contents(rows(spark, path), src(spark, path).fx("fx_projects"))


STAGES = [("stage_1", "6a"), ("stage_2", "6b"), ("stage_3", "6c"), ("stage_4", "6d"), ("unstageable", "6e")]
STAGE = "SELECT {0}, " + s_of("'6a','6b','6c','6d','6e'", "total") + ", " + ", ".join(s_of(f"'{i}'", n) for n, i in STAGES) + " FROM {1} GROUP BY 1 HAVING count(*) FILTER (metric_id IN ('6a','6b','6c','6d','6e')) > 0"


@query("stage_table", STAGE.format("project", "rows_h"))
def stage_table(spark, path):
    return reports.stage_table(rows(spark, path), "project", shares=False)


@query("stage_table_phase", "SELECT *, " + ", ".join(f"round({n} / nullif(total, 0), 4) AS {n}_perc" for n, _ in STAGES) + " FROM ("
       + STAGE.format("phase", "(SELECT r.*, p.phase FROM rows_h r LEFT JOIN fx_projects p ON r.project = p.project)") + ")")
def stage_table_phase(spark, path):
    phased = joins.lookup(rows(spark, path), src(spark, path).fx("fx_projects"), "project", ["phase"])
    return reports.stage_table(phased, "phase", shares=True)


def quoted(ids):
    return ", ".join(f"'{i}'" for i in ids)


SUMS = ", ".join(s_of(quoted(ids), n) for n, ids in reports.SUMMARY_COLUMNS.items())
PHASED = "(SELECT r.*, CASE WHEN p.phase = 'Original' THEN 'Original' WHEN p.phase IS NOT NULL THEN 'Onboarded / Phase 3' END AS grp FROM rows_h r LEFT JOIN fx_projects p ON r.project = p.project)"


@query("summary_by_project", f"""WITH x AS (SELECT project AS "row", {SUMS} FROM {PHASED} GROUP BY 1 UNION ALL SELECT grp, {SUMS} FROM {PHASED} WHERE grp IS NOT NULL GROUP BY 1 UNION ALL SELECT 'Total', {SUMS} FROM {PHASED}),
pop AS (SELECT project AS "row", CAST(eligible_population AS DOUBLE) AS metric_1b FROM fx_projects UNION ALL SELECT 'Total', CAST(sum(eligible_population) AS DOUBLE) FROM fx_projects
 UNION ALL SELECT CASE WHEN phase = 'Original' THEN 'Original' ELSE 'Onboarded / Phase 3' END, CAST(sum(eligible_population) AS DOUBLE) FROM fx_projects GROUP BY 1)
SELECT coalesce(pop.row, x.row) AS "row", metric_1b, x.* EXCLUDE ("row") FROM pop FULL JOIN x ON pop.row = x.row""")
def summary_by_project(spark, path):
    return reports.project_summary(rows(spark, path), src(spark, path).fx("fx_projects"))


COMBOS = {n.removeprefix("metric_"): ids for n, ids in reports.SUMMARY_COLUMNS.items()}


@query("metric_summary_ratio", "WITH num AS (" + " UNION ALL ".join(
    f"SELECT '{k}' AS row_id, CAST(coalesce(sum(numerator), 0) AS DOUBLE) AS number FROM rows_h WHERE metric_id IN ({quoted(ids)})" for k, ids in COMBOS.items())
    + " UNION ALL SELECT '1b', CAST(sum(eligible_population) AS DOUBLE) FROM fx_projects), base(row_id, base_id) AS (VALUES "
    + ", ".join(f"('{a}', '{b}')" for a, b in reports.RATIO_BASE.items())
    + ") SELECT n.row_id, n.number, d.number AS denominator, round(n.number / nullif(d.number, 0), 4) AS value FROM num n LEFT JOIN base b ON n.row_id = b.row_id LEFT JOIN num d ON b.base_id = d.row_id")
def metric_summary_ratio(spark, path):
    return reports.ratio_summary(rows(spark, path), src(spark, path).fx("fx_projects"))


# --- demographic tables

ATTRIBUTES = {
    "gender": ("sex", "coalesce(sex_c, 'Not known')", ["Female", "Male", "Not known"]),
    "age": ("age_band_five", "coalesce(age_band_five, 'Not known')", [*vocab.AGE_BAND_FIVE[1], "Not known"]),
    "deprivation": ("imd_decile", "coalesce(CAST(imd_decile AS VARCHAR), 'Not known')", [*[str(i) for i in range(1, 11)], "Not known"]),
    "ethnicity": ("ethnic_group", "coalesce(ethnic_group, 'Not known')", [*vocab.ETHNIC_GROUP, "Not known"]),
}
KEEP = ["sex", "age_band_five", "imd_decile", "ethnic_group"]
REPORTED = {"invited": ["1a"], "attended": ["3a", "3b"], "referred": ["4a"], "scanned": ["5a"]}


def people(spark, path, ids, staged=False):
    c = views.cohort(spark, path, staged)
    return reshape.union_all([metrics.records(c, i, KEEP) for i in ids])


def record_sql(ids, extra: str) -> str:
    return " UNION ALL ".join(records(i).replace("SELECT ParticipantID,", f"SELECT '{i}' AS metric_id, {extra}, ParticipantID,", 1) for i in ids)


COLS = "sex_c, age_band_five, imd_decile, ethnic_group"


def _pivot(measure: str, attribute: str):
    column, expr, values = ATTRIBUTES[attribute]
    cells = ", ".join(f"count(DISTINCT CASE WHEN a = '{v}' THEN ParticipantID END) AS \"{v}\"" for v in values)
    total = " + ".join(f'"{v}"' for v in values)
    wide = f"SELECT project, {cells} FROM (SELECT ParticipantID, project, {expr} AS a FROM ({record_sql(REPORTED[measure], COLS)})) GROUP BY 1"
    sums = ", ".join(f'CAST(sum("{v}") AS BIGINT)' for v in values)

    @query(f"demographic_pivot_{measure}_{attribute}", f"SELECT *, {total} AS \"Total\" FROM ({wide}) UNION ALL SELECT 'Total', {sums}, CAST(sum({total}) AS BIGINT) FROM ({wide})")
    def run(spark, path):
        frame = people(spark, path, REPORTED[measure], {"scan"} if measure == "scanned" else False)
        return reports.demographic_pivot(frame, column, values)


for _m in REPORTED:
    for _a in ATTRIBUTES:
        _pivot(_m, _a)


def overview_rows(spark, path):
    c = views.cohort(spark, path, staged={"invite", "persons", "check", "checks", "first_checks", "scan"})
    return reports.overview({m: reshape.union_all([metrics.records(c, i, KEEP) for i in ids]) for m, ids in REPORTED.items()})


OVER = " UNION ALL ".join(f"SELECT '{m}' AS metric_name, coalesce(sex_c, 'Not known') AS sex, coalesce(age_band_five, 'Not known') AS age_band_five, coalesce(ethnic_group, 'Not known') AS ethnic_group, imd_decile, ParticipantID FROM ({record_sql(ids, COLS)})" for m, ids in REPORTED.items())
OVERVIEW = f"SELECT metric_name, sex, age_band_five, ethnic_group, imd_decile, count(DISTINCT ParticipantID) AS participants FROM ({OVER}) GROUP BY 1, 2, 3, 4, 5"


@query("overview_multi", OVERVIEW)
def overview_multi(spark, path):
    return overview_rows(spark, path)


@query("demographic_pivot_overview_gender_age", f"""SELECT sex, age, {', '.join(f"CAST(sum(n) FILTER (metric_name = '{m}') AS BIGINT) AS {m}" for m in REPORTED)} FROM (
 SELECT metric_name, CASE WHEN grouping(sex) = 1 THEN 'Total' ELSE sex END AS sex, CASE WHEN grouping(age_band_five) = 1 THEN 'Total' ELSE age_band_five END AS age, sum(participants) AS n
 FROM ({OVERVIEW}) GROUP BY GROUPING SETS ((metric_name, sex, age_band_five), (metric_name, sex), (metric_name))) GROUP BY 1, 2""")
def overview_gender_age(spark, path):
    o = overview_rows(spark, path).groupBy("metric_name", "sex", "age_band_five").agg(F.sum("participants").alias("participants"))
    sets = o.groupingSets([["metric_name", "sex", "age_band_five"], ["metric_name", "sex"], ["metric_name"]], "metric_name", "sex", "age_band_five").agg(
        F.sum("participants").alias("n"), F.grouping("sex").alias("gs"), F.grouping("age_band_five").alias("ga"))
    named = sets.select("metric_name", F.when(F.col("gs") == 1, "Total").otherwise(F.col("sex")).alias("sex"),
                        F.when(F.col("ga") == 1, "Total").otherwise(F.col("age_band_five")).alias("age"), "n")
    return reshape.to_wide(named, ["sex", "age"], "metric_name", list(REPORTED), F.sum("n"))


def _overview(attribute: str, column: str, expr: str):
    cells = ", ".join(f"CAST(coalesce(sum(participants) FILTER (metric_name = '{m}'), 0) AS BIGINT) AS {m}" for m in REPORTED)

    @query(f"demographic_pivot_overview_{attribute}", f"SELECT {expr} AS level, {cells} FROM ({OVERVIEW}) GROUP BY 1 UNION ALL SELECT 'Total', {cells} FROM ({OVERVIEW})")
    def run(spark, path):
        o = overview_rows(spark, path).withColumn("level", F.coalesce(F.col(column).cast("string"), F.lit("Not known")))
        wide = reshape.to_wide(o, ["level"], "metric_name", list(REPORTED), F.sum("participants"), fill=0)
        total = wide.agg(*[F.sum(m).alias(m) for m in REPORTED]).withColumn("level", F.lit("Total"))
        return wide.unionByName(total)


_overview("ethnicity", "ethnic_group", "ethnic_group")
_overview("deprivation", "imd_decile", "coalesce(CAST(imd_decile AS VARCHAR), 'Not known')")


LONG = " UNION ALL ".join(
    f"SELECT project, metric_id, '{a}' AS demographic, {e} AS demographic_value, count(DISTINCT ParticipantID) AS participants FROM ({record_sql(['1a', '3a', '3b', '4a', '5a'], COLS)}) GROUP BY 1, 2, 4"
    for a, (_, e, _) in ATTRIBUTES.items())


@query("demographic_flatfile", f"""WITH c AS (SELECT * FROM ({LONG}) WHERE demographic_value <> 'Age below zero')
SELECT p.metric_id, p.demographic, p.project, v.demographic_value, c.participants FROM (SELECT DISTINCT metric_id, demographic, project FROM c) p
JOIN (SELECT DISTINCT metric_id, demographic, demographic_value FROM c) v ON p.metric_id = v.metric_id AND p.demographic = v.demographic
LEFT JOIN c ON c.metric_id = p.metric_id AND c.demographic = p.demographic AND c.project IS NOT DISTINCT FROM p.project AND c.demographic_value = v.demographic_value""")
def demographic_flatfile(spark, path):
    long = reports.demographic_long(people(spark, path, ["1a", "3a", "3b", "4a", "5a"], {"scan", "check"}), {a: c for a, (c, _, _) in ATTRIBUTES.items()})
    return reports.demographic_flatfile(long)


# --- templates, datasheets, comparison

# Metrics of the template, written out apart from the plans.
TEMPLATE_IDS = ("1a 1c 1b 2 3a 3b 3c 3d 4a 4b 5a 5b 5d 5e 5f 5g 5h 6a 6b 6c 6d 6e 7 7a 7b 7c 7d 7e 7f 7g 7h 7i 7j 7k "
                "7l 7m 7n 7o 7p 7q 7r 7s 7t 7u 8b 8a 9 10 11 12 13 14").split()
TEMPLATE = f"""SELECT p.project_code, p.project, p.phase, p.start_date, p.eligible_population, p.CACode, p.CAName, v.metric_id, CAST(m.month AS DATE) AS month, r.numerator
FROM fx_projects p CROSS JOIN (VALUES {', '.join(f"('{i}')" for i in TEMPLATE_IDS)}) v(metric_id)
CROSS JOIN (SELECT unnest(generate_series(DATE '{SPAN[0]}', DATE '{SPAN[1]}', INTERVAL 1 MONTH)) AS month) m
LEFT JOIN rows_h r ON r.project = p.project AND r.month = m.month AND r.metric_id = v.metric_id"""


# Published names of the template's metrics; those without one stay nameless.
PUBLISHED = {i: metrics.NAMES[{"14": "14a"}.get(i, i)].replace("{programme}", "PROGRAMME") for i in TEMPLATE_IDS if {"14": "14a"}.get(i, i) in metrics.NAMES}


def filled(spark, path):
    projects = src(spark, path).fx("fx_projects")
    submitted = joins.lookup(rows(spark, path), projects, "project", ["project_code"])
    return reports.fill_template(projects, reports.METRIC_ORDER, *SPAN, submitted)


@query("mi_template", TEMPLATE)
def mi_template(spark, path):
    return filled(spark, path)


@query("mi_flatfile", f"""SELECT CACode, CAName, project_code AS ProjectCode, project AS Project, metric_id AS MetricId,
 CASE metric_id {" ".join(f"WHEN '{i}' THEN '{n}'" for i, n in PUBLISHED.items())} END AS Metric, month, numerator AS Numerator FROM ({TEMPLATE}) WHERE metric_id NOT IN {MED}""")
def mi_flatfile(spark, path):
    return reports.flat_file(filled(spark, path), reports.published_names())


@query("datasheet_rows", f"""SELECT h.project, h.month, v.metric_id, v.metric_name, coalesce(a.adj, m.numerator) AS numerator,
 CASE WHEN a.adj IS NOT NULL THEN 'Manual adjustment, original data was ' || coalesce(CAST(m.numerator AS VARCHAR), 'NA') END AS comment, p.project_code
FROM (SELECT DISTINCT project, month FROM fx_metric_rows) h CROSS JOIN (SELECT DISTINCT metric_id, metric_name FROM fx_metric_rows) v
LEFT JOIN fx_metric_rows m ON h.project IS NOT DISTINCT FROM m.project AND h.month = m.month AND v.metric_id = m.metric_id
LEFT JOIN ({ADJ}) a ON h.project = a.project AND h.month = a.month AND v.metric_id = a.metric_id
LEFT JOIN fx_projects p ON h.project = p.project WHERE h.month <= DATE '2026-03-01' AND h.month > DATE '2018-03-01'""")
def datasheet_rows(spark, path):
    s = src(spark, path)
    return reports.datasheet_rows(s.fx("fx_metric_rows"), adjustments(spark, path), s.fx("fx_projects"), "2026-03-01", 96).select(
        "project", "month", "metric_id", "metric_name", "numerator", "comment", "project_code")


MEASURE = "CASE metric_id WHEN '1a' THEN 'invited_first' WHEN '5a' THEN 'initial_scan' ELSE 'attended' END"
PAIR = f"SELECT {{0}} AS Project, month, {MEASURE} AS measure, coalesce(sum(numerator), 0) AS v FROM fx_metric_rows WHERE metric_id IN ('1a','3a','3b','5a') {{1}} GROUP BY 1, 2, 3"


@query("report_diff", f"""SELECT coalesce(a.Project, b.Project) AS Project, coalesce(a.month, b.month) AS month, coalesce(a.measure, b.measure) AS measure, coalesce(a.v, 0) AS current_value,
 coalesce(b.v, 0) AS last_value, coalesce(a.v, 0) - coalesce(b.v, 0) AS difference FROM ({PAIR.format('project', '')}) a
 FULL JOIN ({PAIR.format("CASE project WHEN 'Project 2' THEN 'Project two' ELSE project END", "AND month < DATE '2024-01-01'")}) b ON a.Project IS NOT DISTINCT FROM b.Project AND a.month = b.month AND a.measure = b.measure""")
def report_diff(spark, path):
    flat = src(spark, path).fx("fx_metric_rows").select(F.col("project").alias("Project"), "month", F.col("metric_id").alias("MetricId"),
                                                        F.col("numerator").alias("Numerator"))
    last = flat.filter(F.col("month") < F.lit("2024-01-01").cast("date"))
    return reports.report_difference(reports.comparison_rows(flat), reports.comparison_rows(last, {"Project 2": "Project two"}))


# --- submissions

SUBMITTED = [("Demographics", "demographics", "_DEMOGRAPHICS"), ("Invites", "invite", "_INVITES"), ("LHC", "check", "_CHECKS"), ("Measurements", "measurement", "_MEASUREMENTS"),
             ("Other History", "history", "_HISTORY"), ("LDCT", "scan", "_LDCT"), ("Diagnostics", "diagnostics", "_DIAGNOSTICS"), ("Smoking cessation", "smoking", "_SMOKING")]
HEADS = " UNION ALL ".join(
    f"""SELECT '{n}' AS table_name, * EXCLUDE (last) FROM (SELECT *, max(ReceivedDate) OVER (PARTITION BY project_code) AS last FROM (SELECT DISTINCT SubmittedFile, ReceivedDate, TransactionId, UserEmail,
 regexp_extract(upper(SubmittedFile), '_(\\w{{3,5}}){p}', 1) AS project_code FROM fx_{v} WHERE ReceivedDate >= DATE '2023-01-01')) WHERE ReceivedDate = last""" for n, v, p in SUBMITTED)


def headers(spark, path):
    s = src(spark, path)
    return reshape.union_all([reports.submission_headers(s.fx(f"fx_{v}"), n, p, "2023-01-01") for n, v, p in SUBMITTED])


NAMED = " LEFT JOIN (SELECT project_code, min(project) AS project FROM fx_projects GROUP BY 1) p ON h.project_code = p.project_code"


@query("latest_submission_pivot", "SELECT TransactionId, h.project_code, project, " + ", ".join(
    f"coalesce(max(CASE WHEN ReceivedDate >= DATE '2024-05-15' THEN 'Include' ELSE 'Exclude' END) FILTER (table_name = '{n}'), 'Exclude') AS \"{n}\"" for n, _, _ in SUBMITTED)
    + f" FROM ({HEADS}) h{NAMED} GROUP BY 1, 2, 3")
def latest_submission_pivot(spark, path):
    heads = headers(spark, path).withColumn("include", dates.include_label("ReceivedDate", "2024-06-20"))
    return reports.submission_pivot(heads, [n for n, _, _ in SUBMITTED], "include", "Exclude", src(spark, path).fx("fx_projects"))


@query("submission_views", "SELECT TransactionId, h.project_code, project, " + ", ".join(
    f"max(ReceivedDate) FILTER (table_name = '{n}') AS \"{n}\"" for n, _, _ in SUBMITTED) + f" FROM ({HEADS}) h{NAMED} WHERE h.project_code = 'ORG02' GROUP BY 1, 2, 3")
def submission_views(spark, path):
    return reports.submission_pivot(headers(spark, path), [n for n, _, _ in SUBMITTED], "ReceivedDate", None, src(spark, path).fx("fx_projects")).filter("project_code = 'ORG02'")


@query("submitter_adjustment", f"""SELECT coalesce(f.month, a.month) AS month, followup_invitations, accepted_invitations FROM
 (SELECT month, count(DISTINCT ParticipantID) AS followup_invitations FROM (SELECT ParticipantID, first_letter_m AS month FROM cl_invite WHERE org_code = 'ORG01' AND first_letter_d >= DATE '2022-08-01'
  UNION ALL SELECT ParticipantID, second_letter_m FROM cl_invite WHERE org_code = 'ORG01' AND second_letter_d >= DATE '2022-08-01') GROUP BY 1) f
 FULL JOIN (SELECT greatest(first_letter_m, second_letter_m) AS month, count(DISTINCT ParticipantID) AS accepted_invitations FROM cl_invite
  WHERE org_code = 'ORG01' AND {E} AND accepted = 'Accepted' AND outcome_m IS NOT NULL GROUP BY 1) a ON f.month = a.month
WHERE coalesce(f.month, a.month) >= DATE '2022-08-01'""")
def submitter_adjustment(spark, path):
    one = views.cohort(spark, path).clean_invites.filter("org_code = 'ORG01'")
    return reports.submitter_adjustment(one, "2022-08-01")
