"""Registered queries, invariants of the results and of the plans."""

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortwise.checks import cohort_views as views
from cohortwise.checks.all_queries import QUERIES, SQL
from cohortwise.plans import models, pathway, reports
from cohortwise.sources import io
from cohortwise.sources.fixtures import GIVEN


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


def frames(spark, path, name):
    con = duckdb.connect()
    for t in GIVEN:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    cur = con.execute(SQL[name])
    cols = [c[0] for c in cur.description]
    df = QUERIES[name](spark, path)
    order = [df.columns.index(c) for c in cols]
    clean = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(clean(r[i]) for i in order) for r in df.collect()), key=str)
    return got, sorted((tuple(clean(v) for v in r) for r in cur.fetchall()), key=str)


@pytest.mark.parametrize("name", [
    "latest_per_person_scan", "scan_pathway", "nearest_event_interval", "asof_prior_event", "fingerprint_dedup", "fuzzy_match_terms",
    "metric_1a", "metric_5a", "metric_7a", "metric_10", "metric_table", "summary_by_project", "report_diff", "consolidated_diagnoses",
    "event_diagnosis_link", "flow_table", "file_quarantine"])
def test_against_sql(spark, small, name):
    got, want = frames(spark, small, name)
    assert got == want


def test_one_pass_equals_single_metrics(spark, small):
    every = {(r.metric_id, r.project, r.month): r.numerator for r in QUERIES["metrics_all"](spark, small).collect()}
    for m in ["1c", "5d", "12", "7q"]:
        single = {(m, r.project, r.month): float(r.numerator) for r in QUERIES[f"metric_{m}"](spark, small).collect()}
        assert single == {k: v for k, v in every.items() if k[0] == m}


def test_flow_is_conserved(spark, small):
    c = views.cohort(spark, small, staged=True)
    cube = c.stage(pathway.cube(pathway.milestones(c, views.all_diagnoses(c, spark))), "cube")
    people = cube.agg(F.sum("participants")).first()[0]
    flows = pathway.flow_table(cube)
    assert flows.filter("step = 1").agg(F.sum("flow")).first()[0] == people
    assert flows.filter("step = 11").agg(F.sum("flow")).first()[0] == people
    nodes = pathway.flow_nodes(flows)
    assert nodes.filter("flow_perc > 100.0 * 12").count() == 0


def test_no_pairing_of_whole_tables(spark, small):
    for name in ["nearest_event_interval", "nearest_event_group", "asof_prior_event", "fuzzy_match_terms", "template_cross",
                 "complete_combinations", "demographic_flatfile", "metric_summary_ratio", "latest_snapshot_only", "funnel_counts"]:
        plan = QUERIES[name](spark, small)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_filters_reach_the_scan(spark, small):
    plan = QUERIES["scan_filter_pushdown"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "o_orderpriority" not in plan


def test_odds_ratio_model_equals_closed_form(spark):
    df = spark.createDataFrame([("a", True, 30), ("a", False, 70), ("b", True, 10), ("b", False, 90)], "g string, k boolean, w int")
    closed = models.odds_ratio_2x2(df, F.col("g") == "b", F.col("k"), "w").first()
    fitted = models.odds_ratio_model(df, F.col("k"), ["g"], "w").first()
    assert fitted.term == "g=b"
    assert abs(fitted.odds_ratio - closed.odds_ratio) < 1e-3 and abs(fitted.upper - closed.upper) < 1e-2


def test_second_run_gives_the_same(spark, small):
    first = sorted(map(str, QUERIES["latest_per_person_ct"](spark, small).collect()))
    assert first == sorted(map(str, QUERIES["latest_per_person_ct"](spark, small).collect()))


def test_file_rows_and_months(spark):
    df = spark.createDataFrame([("1a", 0.0), ("zz", 1.0), ("1a", None)], "metric_id string, numerator double")
    assert [r.dq_problem for r in io.row_flags(df, ["1a"]).collect()] == [True, True, True]
    assert reports.month_list("2019-11-01", "2020-02-01") == ["2019-11-01", "2019-12-01", "2020-01-01", "2020-02-01"]


def test_work_dir_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert io.work_dir(spark) == (named or spark.sparkContext.getCheckpointDir())
    assert io.fresh_path(spark, "x").startswith(io.work_dir(spark).rstrip("/") + "/x-")
