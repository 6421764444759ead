"""Queries on scans, files and snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.checks import cohort_views as views
from cohortwise.checks.registry import query
from cohortwise.functions import dates
from cohortwise.operators import joins, reshape
from cohortwise.plans import diagnoses, metrics, reports
from cohortwise.sources import io
from cohortwise.sources.fixtures import GIVEN, Source


@query("scan_filter_pushdown", """
SELECT o_custkey, CAST(count(*) AS BIGINT) AS orders, round(sum(o_totalprice), 2) AS value FROM orders
WHERE o_orderstatus = 'F' AND o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' GROUP BY 1""")
def scan_filter_pushdown(spark, path):
    orders = Source(spark, path).table("orders")
    return (orders.filter((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")))
            .groupBy("o_custkey").agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("value")))


@query("load_all_counts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(count(*) AS BIGINT) AS n FROM {t}" for t in GIVEN))
def load_all_counts(spark, path):
    loaded = io.read_tables(spark, path, GIVEN)
    return reduce(DataFrame.unionByName,
                  [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in loaded.items()])


@query("snapshot_roundtrip", """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS order_date FROM orders""")
def snapshot_roundtrip(spark, path):
    df = Source(spark, path).table("orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                                    F.col("o_orderdate").cast("date").alias("order_date"))
    return io.save_snapshot(df, io.fresh_path(spark, "snapshot"))


@query("lookup_enrich", """
SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def lookup_enrich(spark, path):
    s = Source(spark, path)
    df = joins.lookup(s.table("customer").withColumnRenamed("c_nationkey", "key"), s.table("nation"), "key",
                      {"n_name": "n_name", "n_regionkey": "region_key"}, "n_nationkey")
    return joins.lookup(df, s.table("region"), "region_key", {"r_name": "r_name"}, "r_regionkey").select("c_custkey", "n_name", "r_name")


@query("icd_group_lookup", """
SELECT p_partkey, code3, CASE WHEN code3 IN ('C76','C77','C78','C79','C80','C74','C75','C97') THEN 'Unknown'
  ELSE CASE code3 WHEN 'C34' THEN 'Lung' WHEN 'C50' THEN 'Breast' WHEN 'C61' THEN 'Urological' WHEN 'D09' THEN 'Urological' END END AS site_group
FROM (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'C34' WHEN 1 THEN 'C50' WHEN 2 THEN 'C61' WHEN 3 THEN 'C76' WHEN 4 THEN 'D09' ELSE 'X99' END AS code3 FROM part)""")
def icd_group_lookup(spark, path):
    groups = diagnoses.icd_groups(views.site_codes(spark))
    code = F.element_at(F.array(*[F.lit(c) for c in ["C34", "C50", "C61", "C76", "D09", "X99"]]), (F.col("p_partkey") % 6 + 1).cast("int"))
    parts = Source(spark, path).table("part").select("p_partkey", code.alias("code3"))
    return joins.lookup(parts, groups.filter("site3 IS NOT NULL"), "code3", {"site3": "site_group"}).select("p_partkey", "code3", "site_group")


@query("aggregate_submission_load", "SELECT project, month, metric_id, metric_name, numerator FROM stage_rows")
def aggregate_submission_load(spark, path):
    return metrics.stage_submissions(Source(spark, path).fx("fx_stage_submissions"), ["Project 3"]).select(
        "project", "month", "metric_id", "metric_name", "numerator")


@query("multi_file_tagged_read", """
SELECT o_orderpriority AS source_group, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT o_orderkey % 4) AS BIGINT) AS files FROM orders GROUP BY 1""")
def multi_file_tagged_read(spark, path):
    out = io.fresh_path(spark, "submissions")
    rows = Source(spark, path).table("orders").select(F.col("o_orderkey").cast("string").alias("row_id"), "o_custkey", "o_orderpriority")
    rows = rows.withColumns({"source_group": F.col("o_orderpriority"), "submission": F.col("row_id").cast("long") % 4})
    rows.write.partitionBy("source_group", "submission").csv(out, header=True)
    schema = io.text_schema(["row_id", "o_custkey", "o_orderpriority"], {"o_custkey": T.LongType()})
    tagged = io.read_submissions(spark, [out], schema, "row_id")
    part = lambda name: F.url_decode(F.regexp_extract("source_file", name + r"=([^/]+)/", 1))  # of the folder, not of the rows
    return (tagged.groupBy(part("source_group").alias("source_group"))
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct(part("submission")).alias("files")))


FILE_PARTS = """SELECT page_id, folder_file, nullif(regexp_extract(folder_file, '([^/]+)/([^/_]+)_([A-Za-z]+)_(\\d{4})\\.xlsx$', 1), '') AS ccg_name,
  nullif(regexp_extract(folder_file, '([^/]+)/([^/_]+)_([A-Za-z]+)_(\\d{4})\\.xlsx$', 2), '') AS ccg_code,
  CAST(try_strptime('1 ' || regexp_extract(folder_file, '([^/]+)/([^/_]+)_([A-Za-z]+)_(\\d{4})\\.xlsx$', 3) || ' ' ||
    regexp_extract(folder_file, '([^/]+)/([^/_]+)_([A-Za-z]+)_(\\d{4})\\.xlsx$', 4), '%d %b %Y') AS DATE) AS file_date FROM fx_files"""


@query("path_parse", f"SELECT page_id, ccg_name, ccg_code, file_date FROM ({FILE_PARTS})")
def path_parse(spark, path):
    return io.parse_path(Source(spark, path).fx("fx_files"), "folder_file").select("page_id", "ccg_name", "ccg_code", "file_date")


@query("file_quarantine", f"""
SELECT page_id, dq_message, c AND m AND w AND b AND a AND f AS dq_flag FROM (SELECT *,
  CASE WHEN NOT w THEN 'Excluded' WHEN NOT b THEN 'Excluded - backup file' WHEN NOT a THEN 'Archived' WHEN NOT f THEN 'DQ - folder/file not in expected format'
    WHEN NOT c THEN 'DQ - CCG code not in accepted list' WHEN NOT m THEN 'DQ - month is not in reporting period' ELSE 'Unknown' END AS dq_message
FROM (SELECT page_id, coalesce(ccg_code IN (SELECT project_code FROM fx_projects), FALSE) AS c,
  coalesce(file_date BETWEEN DATE '2019-04-01' AND DATE '2024-03-01', FALSE) AS m, folder_file NOT IN ('Working.xlsx', 'ProjCode_Month_Year.xlsx') AS w,
  folder_file NOT LIKE '%~%' AS b, NOT regexp_matches(folder_file, 'archive|Archive') AS a,
  regexp_matches(folder_file, '.*/.*_.*_\\d{{4}}\\.xlsx') AS f FROM ({FILE_PARTS})))""")
def file_quarantine(spark, path):
    s = Source(spark, path)
    files = io.parse_path(s.fx("fx_files"), "folder_file")
    flagged = io.file_flags(files, "folder_file", s.fx("fx_projects").select("project_code"), "2019-04-01", "2024-03-01")
    accepted, rejected = io.accepted_and_rejected(flagged)
    return accepted.unionByName(rejected).select("page_id", "dq_message", "dq_flag")


@query("adjustments_load", """
SELECT project, CAST(date_trunc('month', month) AS DATE) AS month, metric_id, numerator AS adjusted_numerator
FROM fx_adjustments WHERE active = 'TRUE' AND date_removed IS NULL""")
def adjustments_load(spark, path):
    return reports.active_adjustments(Source(spark, path).fx("fx_adjustments"))


@query("flatfile_export", """
SELECT project, metric_id, strftime(month, '%Y-%m-%d') AS month, CAST(numerator AS VARCHAR) AS numerator FROM fx_metric_rows WHERE metric_id NOT IN ('10','11','12','13')""")
def flatfile_export(spark, path):
    rows = Source(spark, path).fx("fx_metric_rows").select("project", "metric_id", "month", "numerator").filter(
        ~F.col("metric_id").isin("10", "11", "12", "13"))
    out = io.fresh_path(spark, "flatfile")
    io.write_csv(rows, out)
    return io.read_csv(spark, out, io.text_schema(["project", "metric_id", "month", "numerator"]))


@query("datasheet_partitions", """
SELECT project, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT month) AS BIGINT) AS months FROM fx_metric_rows GROUP BY 1""")
def datasheet_partitions(spark, path):
    rows = Source(spark, path).fx("fx_metric_rows").withColumn("project_code", F.col("project")).withColumn("metric_order", F.col("metric_id"))
    out = io.fresh_path(spark, "datasheets")
    io.write_datasheets(rows.withColumn("month", F.date_format("month", "yyyyMM")), out)
    back = spark.read.option("header", True).csv(out)
    return back.groupBy(F.col("project_code").alias("project")).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("month").alias("months"))


@query("report_bundle", """
SELECT 'by_metric' AS report, metric_id AS label, sum(numerator) AS numerator FROM fx_metric_rows GROUP BY 2
UNION ALL SELECT 'by_project', project, sum(numerator) FROM fx_metric_rows GROUP BY 2""")
def report_bundle(spark, path):
    rows = Source(spark, path).fx("fx_metric_rows")
    bundle = {f"by_{k}": rows.groupBy(F.col(c).alias("label")).agg(F.sum("numerator").alias("numerator"))
              for k, c in [("metric", "metric_id"), ("project", "project")]}
    paths = io.write_bundle(bundle, io.fresh_path(spark, "bundle"))
    return reshape.union_all([spark.read.parquet(p).withColumn("report", F.lit(p.rsplit("/", 1)[1])) for p in paths]).select(
        "report", "label", "numerator")


FLAT = """SELECT project AS Project, month, metric_id AS MetricId, numerator AS Numerator FROM fx_metric_rows"""


@query("report_pair_load", f"""
SELECT 'current' AS report, Project, month, CASE MetricId WHEN '1a' THEN 'invited_first' WHEN '5a' THEN 'initial_scan' ELSE 'attended' END AS measure, Numerator
FROM ({FLAT}) WHERE MetricId IN ('1a','3a','3b','5a')
UNION ALL SELECT 'last', CASE Project WHEN 'Project 2' THEN 'Project two' ELSE Project END, month,
 CASE MetricId WHEN '1a' THEN 'invited_first' WHEN '5a' THEN 'initial_scan' ELSE 'attended' END, Numerator
FROM ({FLAT}) WHERE MetricId IN ('1a','3a','3b','5a') AND month < DATE '2024-01-01'""")
def report_pair_load(spark, path):
    flat = Source(spark, path).fx("fx_metric_rows").select(F.col("project").alias("Project"), "month", F.col("metric_id").alias("MetricId"),
                                                           F.col("numerator").alias("Numerator"))
    current = reports.comparison_rows(flat)
    last = reports.comparison_rows(flat.filter(F.col("month") < F.lit("2024-01-01").cast("date")), {"Project 2": "Project two"})
    return reshape.union_all([current.withColumn("report", F.lit("current")), last.withColumn("report", F.lit("last"))]).select(
        "report", "Project", "month", "measure", "Numerator")


@query("base_frames", " UNION ALL ".join(
    f"SELECT '{n}' AS frame, project, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT ParticipantID) AS BIGINT) AS people FROM {b} GROUP BY project"
    for n, b in [("invites", "b_invites"), ("checks", "b_checks"), ("measurements", "b_meas"), ("scans", "b_scans"),
                 ("diagnostics", "b_diag"), ("history", "b_history"), ("smoking", "b_smoking")]))
def base_frames(spark, path):
    c = views.cohort(spark, path, staged={"invite", "measurement", "persons", "check", "checks", "first_checks", "scan"})
    names = ["invites", "checks", "measurements", "scans", "diagnostics", "history", "smoking"]
    return reshape.union_all([
        getattr(c, n).groupBy("project").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("ParticipantID").alias("people"))
        .withColumn("frame", F.lit(n)) for n in names]).select("frame", "project", "n", "people")


@query("registry_scan", """
SELECT DatasetId, SITE_ICD10_3CHAR AS code, CAST(count(*) AS BIGINT) AS n FROM fx_registry GROUP BY 1, 2""")
def registry_scan(spark, path):
    return (Source(spark, path).fx("fx_registry").groupBy("DatasetId", F.col("SITE_ICD10_3CHAR").alias("code"))
            .agg(F.count(F.lit(1)).alias("n")))


# Order of the metrics in reports, as the twin states it.
ORDERED_IDS = ("1a 1c 1b 2 3a 3b 3c 3d 4a 4b 5a 5b 5d 5e 5f 5g 5h 6a 6b 6c 6d 6e 7 7a 7b 7c 7d 7e 7f 7g 7h 7i 7j 7k "
               "7l 7m 7n 7o 7p 7q 7r 7s 7t 7u 8b 8a 9 10 11 12 13 14").split()


@query("template_order", f"""
SELECT metric_id, min(coalesce(list_position([{", ".join(f"'{i}'" for i in ORDERED_IDS)}], metric_id), {len(ORDERED_IDS) + 1})) AS metric_order, sum(numerator) AS numerator
FROM rows_h GROUP BY 1""")
def template_order(spark, path):
    rows = reports.harmonise_ids(Source(spark, path).fx("fx_metric_rows"))
    return rows.withColumn("o", reports._metric_order()).groupBy("metric_id").agg(F.min("o").alias("metric_order"), F.sum("numerator").alias("numerator"))


# Lines that cannot be read, and rows that can but fail a check.
BROKEN = "metric_id IN ('1c', '5b') AND month(month) = 5"
ZERO = "metric_id = '3a' AND month(month) = 7"
CHECKED_IDS = "('1a', '1c', '2', '3a', '3b', '3c', '3d', '4b', '5a', '5b', '5d', '5e', '7', '8a', '8b')"


@query("submitted_row_checks", f"""
SELECT metric_id, dq_metric_id, dq_numerator_na, dq_numerator_zero, dq_broken, NOT dq_metric_id OR dq_numerator_na OR dq_numerator_zero OR dq_broken AS dq_problem, count(*) AS n FROM (
 SELECT metric_id, metric_id IN {CHECKED_IDS} AS dq_metric_id, CASE WHEN {BROKEN} THEN true WHEN {ZERO} THEN false ELSE numerator IS NULL END AS dq_numerator_na,
  {ZERO} AS dq_numerator_zero, {BROKEN} AS dq_broken FROM fx_metric_rows) GROUP BY ALL""")
def submitted_row_checks(spark, path):
    out = io.fresh_path(spark, "submitted")
    told = F.when(F.expr(BROKEN), "about ten").when(F.expr(ZERO), "0").otherwise(F.coalesce(F.col("numerator").cast("string"), F.lit("")))
    rows = Source(spark, path).fx("fx_metric_rows").select(F.col("project"), "metric_id", F.col("month").cast("string").alias("month"), told.alias("numerator"))
    io.write_csv(rows, out)
    back = io.read_checked(spark, out, io.text_schema(["project", "metric_id", "month", "numerator"], {"numerator": T.DoubleType()}))
    ids = [i.strip(" '") for i in CHECKED_IDS.strip("()").split(",")]
    return io.row_flags(back, ids, "broken_row").groupBy(
        "metric_id", "dq_metric_id", "dq_numerator_na", "dq_numerator_zero", "dq_broken", "dq_problem").agg(F.count(F.lit(1)).alias("n"))


@query("file_listing", f"""
SELECT folder_file, any_value(ccg_code) AS ccg_code, any_value(file_date) AS file_date, bool_and(coalesce(ccg_code IN (SELECT project_code FROM fx_projects), FALSE)
  AND coalesce(file_date BETWEEN DATE '2019-04-01' AND DATE '2024-03-01', FALSE) AND folder_file NOT IN ('Working.xlsx', 'ProjCode_Month_Year.xlsx') AND folder_file NOT LIKE '%~%'
  AND NOT regexp_matches(folder_file, 'archive|Archive') AND regexp_matches(folder_file, '.*/.*_.*_\\d{{4}}\\.xlsx')) AS dq_flag FROM ({FILE_PARTS}) GROUP BY folder_file""")
def file_listing(spark, path):
    """Files written from the given rows, found again by listing their folders."""
    s, out = Source(spark, path), io.fresh_path(spark, "inbox")
    named = s.fx("fx_files").select("page_id", F.coalesce(F.nullif(F.regexp_extract("folder_file", "^(.*)/", 1), F.lit("")), F.lit(".")).alias("folder"),
                                    F.regexp_extract("folder_file", "([^/]+)$", 1).alias("file"))
    named.repartition("folder", "file").write.partitionBy("folder", "file").csv(out)
    part = lambda c: F.url_decode(F.regexp_replace(F.regexp_extract("path", f"/{c}=([^/]+)/", 1), r"\+", "%2B"))
    # listed paths escape what the folders' names escaped
    listed = io.list_files(spark, out).select(F.url_decode(F.regexp_replace("path", r"\+", "%2B")).alias("path"))
    found = listed.select(F.when(part("folder") == ".", part("file")).otherwise(F.concat(part("folder"), F.lit("/"), part("file"))).alias("folder_file")).distinct()
    flagged = io.file_flags(io.parse_path(found, "folder_file"), "folder_file", s.fx("fx_projects").select("project_code"), "2019-04-01", "2024-03-01")
    return flagged.select("folder_file", "ccg_code", "file_date", "dq_flag")
