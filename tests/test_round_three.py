"""Findings of the third round."""

import datetime as d
from collections import Counter

from pyspark.sql import functions as F

from cohortwise.checks import all_queries
from cohortwise.checks import cohort_views as views
from cohortwise.functions import dates
from cohortwise.operators import joins
from cohortwise.sources import io
from cohortwise.sources.fixtures import Source

QUERIES = all_queries.QUERIES


def test_report_groupings_has_a_row_per_invited_person(spark, small):
    got = QUERIES["report_groupings"](spark, small)
    assert got.columns == ["ParticipantID", "rpt_imd", "rpt_age", "rpt_ethnicity", "rpt_triage"]
    people = lambda df: Counter(r.ParticipantID for r in df.select("ParticipantID").collect())
    assert people(got) == people(QUERIES["invite_sequence"](spark, small)) != Counter()


def test_a_text_date_is_matched_once(spark):
    df = spark.createDataFrame([("x",)], "t string").select(dates.parse_date("t").alias("d"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1 and "gettimestamp" not in plan


def test_odd_text_dates(spark):
    day = d.date
    cases = {
        "29/02/2024": day(2024, 2, 29), "29/02/2023": None, "1/2/2020 7:05": day(2020, 2, 1), "1/2/2020 24:00": None, "1/2/2020 10:60": None,
        "mAR 5 2021 10:30": day(2021, 3, 5), "Foo 5 2021 10:30": None, "Mar 5 2021": None, "5-3-21": day(2021, 3, 5), "05-MAR-99": day(2099, 3, 5),
        "2021-3-5 0:00:59": day(2021, 3, 5), "2021-3-5 0:00:60": None, "20210305": day(2021, 3, 5), "20211305": None, "01/02/2020\n": None,
        " 01/02/2020": None, "01/02/2020x": None, "01/02/2020 ": None, "2021-03-05": None, "5-Ma-21": None, "43556": day(2019, 4, 1), "": None, None: None}
    got = spark.createDataFrame([(t,) for t in cases], "t string").select("t", dates.parse_date("t").alias("d")).collect()
    assert {r.t: r.d for r in got} == cases


def test_long_expressions_of_the_views_are_compiled(spark, small):
    s = Source(spark, small)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    assert s.fx("fx_scan").agg(F.count("LDCT_Date")).first()[0] == s.table("lineitem").count()


def rows(df):
    return Counter(map(tuple, df.select(sorted(df.columns)).collect()))


def test_rows_that_lie_by_person_are_not_moved_again_when_written(spark, small, monkeypatch):
    frame, moved = type(spark.range(1)), []
    monkeypatch.setattr(frame, "repartition", lambda df, *a, old=frame.repartition: moved.append(a) or old(df, *a))
    c, plain = views.cohort(spark, small, {"invite", "scan", "clean_scans", "persons"}), views.cohort(spark, small)
    assert rows(c.current("invite")) == rows(plain.current("invite"))
    assert rows(c.clean_scans) == rows(plain.clean_scans)
    assert len(moved) == 1  # scans are selected by person and date


def test_a_written_frame_has_the_columns_that_are_read(spark, small):
    kept = {"checks": ["ParticipantID", "check_month"]}
    c, plain = views.cohort(spark, small, {"checks"}, kept), views.cohort(spark, small)
    assert c.checks.columns == kept["checks"]
    assert rows(c.checks) == rows(plain.checks.select(*kept["checks"]))


def test_tasks_on_raw_records_get_less_input_unless_the_session_says_how_much(spark, small):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        Source(spark, small)
        assert spark.conf.get(name) == io.TASK_INPUT[name]
        spark.conf.set(name, "32m")
        Source(spark, small)
        assert spark.conf.get(name) == "32m"
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_scored_tokens_are_written_before_they_are_joined(spark):
    df = spark.createDataFrame([(1, "noduel"), (2, "nodule"), (3, None), (4, "cyst"), (5, "cyst")], "i int, token string")
    seen = []
    got = joins.closest_terms(df, "token", ["nodule", "cysts"], lambda scored: seen.append(scored.count()) or scored)
    assert seen == [3]
    assert rows(got) == rows(joins.closest_terms(df, "token", ["nodule", "cysts"]))
