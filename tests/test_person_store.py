"""The person store: staged frames in buckets of the person, and one person table that all base frames join."""

import datetime as d
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortwise.checks import cohort_views as views
from cohortwise.checks.q_metrics import ALL_STAGED
from cohortwise.plans import metrics, tables, vocab
from cohortwise.sources import io


@pytest.fixture
def shuffled_joins(spark):
    """No broadcasts, and plans as first made, so that a missing exchange is the buckets' doing."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def by_person(plan):
    return [line for line in plan.splitlines() if "Exchange hashpartitioning(ParticipantID" in line]


def test_bucketed_frames_join_and_group_without_a_shuffle(spark, shuffled_joins):
    a = io.save_bucketed(spark.range(2000).selectExpr("CAST(id % 500 AS STRING) AS k", "id AS x"), io.fresh_path(spark, "a"), "k")
    b = io.save_bucketed(spark.range(700).selectExpr("CAST(id AS STRING) AS k", "id AS y"), io.fresh_path(spark, "b"), "k")
    both = a.join(b, "k", "left").groupBy("k").agg(F.count("y").alias("n"))
    assert "Exchange" not in plan_of(both)
    assert both.agg(F.sum("n"), F.count("*")).first() == (2000, 500)


def test_a_written_table_keeps_missing_keys_and_is_released(spark):
    path = io.fresh_path(spark, "missing")
    got = io.save_bucketed(spark.createDataFrame([(None, 1), ("p", 2), (None, 3), ("", 4)], "k string, x int"), path, "k")
    assert sorted(r.x for r in got.collect()) == [1, 2, 3, 4]
    assert io.save_bucketed(spark.createDataFrame([], "k string, x int"), io.fresh_path(spark, "empty"), "k").count() == 0
    assert spark.catalog.tableExists(io._table_name(path))
    written = list(io._WRITTEN)
    try:
        io._WRITTEN[:] = [path]
        io.release(spark)
        assert not spark.catalog.tableExists(io._table_name(path))
    finally:
        io._WRITTEN[:] = [p for p in written if p != path]


def test_scan_metric_moves_no_staged_frame_by_person(spark, small, shuffled_joins):
    c = views.cohort(spark, small, {"scan", "persons", "check", "first_checks"})
    # What else is grouped by person is the median's own key; rows of persons, checks and scans stay in their buckets.
    plan = plan_of(metrics.records(c, "12"))
    assert by_person(plan) == []
    assert plan.count("FileScan") <= 15


@pytest.fixture(scope="module")
def cohorts(spark, small):
    return views.cohort(spark, small, ALL_STAGED), views.cohort(spark, small, ALL_STAGED - {"persons"})


@pytest.mark.parametrize("base", ["invites", "checks", "measurements", "scans", "diagnostics", "smoking"])
def test_base_frames_are_those_of_the_separate_joins(cohorts, base):
    one, apart = (getattr(c, base) for c in cohorts)
    assert sorted(one.columns) == sorted(apart.columns) and one.count() > 0
    rows = lambda df: Counter(map(tuple, df.select(sorted(one.columns)).collect()))
    assert rows(one) == rows(apart)


def test_first_performed_scan_of_each_person(spark):
    day = lambda n: d.date(2020, 1, n)
    rows = [("p", day(9), vocab.PERFORMED), ("p", day(3), vocab.PERFORMED), ("p", day(1), "other"), ("q", day(2), "other"),
            ("q", None, vocab.PERFORMED), (None, day(5), vocab.PERFORMED), (None, day(4), vocab.PERFORMED)]
    got = tables.time_scans(spark.createDataFrame(rows, "ParticipantID string, scan_date date, scan_outcome string")).collect()
    days = sorted((r.ParticipantID or "", r.scan_date, r.days_from_first) for r in got if r.scan_date)
    assert days == [("", day(4), None), ("", day(5), None), ("p", day(1), -2), ("p", day(3), 0), ("p", day(9), 6), ("q", day(2), None)]
