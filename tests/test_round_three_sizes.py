"""Findings of the third round on time at 6 GB: what is moved, joined and computed once."""

import datetime as d
from collections import Counter

from pyspark.sql import functions as F

from cohortwise.checks import all_queries
from cohortwise.checks import cohort_views as views
from cohortwise.operators import joins
from cohortwise.plans import metrics
from cohortwise.plans.cohort import FINDINGS, TIMED


def rows(df, columns=None):
    return Counter(map(tuple, df.select(sorted(columns or df.columns)).collect()))


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_each_distinct_text_is_split_and_scored_once(spark, small, monkeypatch):
    seen, whole = [], joins.closest_terms
    monkeypatch.setattr(joins, "closest_terms", lambda df, *a, **k: seen.append(df) or whole(df, *a, **k))
    c = views.cohort(spark, small, {"scan", "terms"}, views.KEEP_METRICS, plain={"scan"})
    got = metrics.records(c, "7b")
    texts = c.current("scan").select("Other_Incidental_Findings").distinct().dropna().count()
    assert [df.select("Other_Incidental_Findings").distinct().count() for df in seen] == [texts]
    assert seen[0].count() < 4 * texts < c.current("scan").count()
    assert got.count() > 0


def test_single_findings_move_no_scans_by_person_to_time_them(spark, small):
    c = views.cohort(spark, small)
    assert "first_date" not in plan_of(metrics.records(c, "7b")) and "Window [min(" not in plan_of(metrics.records(c, "7b"))
    for column, terms in FINDINGS.values():
        timed, plain = c.findings(column, terms), c.findings(column, terms, timed=False)
        assert set(timed.columns) == {*plain.columns, *TIMED}
        assert rows(timed, plain.columns) == rows(plain) != Counter()


def test_records_of_a_finding_keep_the_columns_of_its_time(spark, small):
    c = views.cohort(spark, small)
    got = metrics.records(c, "7b", ["scan_category", "days_from_first"])
    assert {"scan_category", "days_from_first"} < set(got.columns)
    assert rows(got, ["ParticipantID", "month"]) == rows(metrics.records(c, "7b"), ["ParticipantID", "month"])


def test_a_finding_metric_writes_scans_and_terms_alone(spark, small, monkeypatch):
    written, save = [], type(spark.range(1).write).parquet
    monkeypatch.setattr(type(spark.range(1).write), "parquet", lambda w, path, *a, **k: written.append(path.rsplit("/", 1)[-1].split("-")[0]) or save(w, path, *a, **k))
    assert all_queries.QUERIES["metric_7d"](spark, small).count() > 0
    assert sorted(written) == ["scan", "terms"]


def test_prior_events_are_joined_once(spark):
    day = lambda n: d.date(2020, 1, n)
    events = [("p", day(3), "b", 2), ("p", day(3), "a", 1), ("p", day(9), "c", 1), ("p", None, "n", 0), ("q", day(1), None, 1), (None, day(1), "z", 1)]
    outcomes = [(1, "p", day(3)), (2, "p", day(2)), (3, "p", day(8)), (3, "p", day(8)), (4, "p", day(30)), (5, "q", day(2)), (6, None, day(2)), (7, "p", None), (None, "p", day(9))]
    e = spark.createDataFrame(events, "p string, ed date, eid string, o int")
    o = spark.createDataFrame(outcomes, "oid int, p string, od date")
    got = joins.prior_event(e, o, "p", "eid", "ed", F.col("o"), "oid", "od")
    assert rows(got, ["oid", "eid", "days_diff"]) == Counter({(0, "a", 1): 1, (5, "a", 3): 1, (21, "c", 4): 1, (1, None, 5): 1, (0, "c", None): 1})
    assert plan_of(got).count("Join Inner") == 1
