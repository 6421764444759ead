"""One query per metric, and all metrics together."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.checks import cohort_views as views
from cohortwise.checks.registry import query
from cohortwise.checks.sql_parts import METRIC_IDS, metric
from cohortwise.plans import metrics
from cohortwise.plans.cohort import FINDINGS
from cohortwise.sources.fixtures import Source


# What a base frame reads more than once is written out first: the selected scans, and
# the terms of their texts, so that Spark knows the size of these.
STAGED = {"scans": {"scan"}, "other_findings": {"scan", "terms"}, "pulmonary_findings": {"scan", "terms"}}
ALL_STAGED = {"lines", "invite", "measurement", "persons", "check", "checks", "first_checks", "scan", "clean_scans", "scans", "terms", "smoking", "diagnostics"}


def _metric(metric_id: str):
    @query(f"metric_{metric_id}", metric(metric_id))
    def run(spark, path):
        base = "any" if metric_id == "7" else metrics.BY_ID[metric_id].base
        staged = {"scan", "clean_scans", "terms"} if base == "any" else STAGED.get(base, False)
        if base == "scans" and "first_check" in metrics.BY_ID[metric_id].needs:
            staged = staged | {"persons", "check", "first_checks"}
        c = views.cohort(spark, path, staged, views.KEEP_METRICS, plain={"scan"} if base in FINDINGS else ())
        return metrics.metric(c, metric_id).select("project", "month", "numerator")


for _id in METRIC_IDS:
    _metric(_id)


def _stage(metric_id: str):
    @query(f"metric_{metric_id}", f"SELECT project, month, numerator FROM stage_rows WHERE metric_id = '{metric_id}'")
    def run(spark, path):
        rows = metrics.stage_submissions(Source(spark, path).fx("fx_stage_submissions"), ["Project 3"])
        return rows.filter(F.col("metric_id") == metric_id).select("project", "month", "numerator")


for _id in ["6a", "6b", "6c", "6d", "6e", "6f"]:
    _stage(_id)


@query("metrics_all", "SELECT project, month, metric_id, numerator FROM m_all")
def metrics_all(spark, path):
    submissions = metrics.stage_submissions(Source(spark, path).fx("fx_stage_submissions"), ["Project 3"])
    return metrics.all_metrics(views.cohort(spark, path, staged=ALL_STAGED, keep=views.KEEP_METRICS), submissions).select("project", "month", "metric_id", "numerator")
