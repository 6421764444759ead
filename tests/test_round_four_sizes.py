"""Findings of the fourth round on disk and time at 6 GB: records are moved once, by person, and what lies by person stays there."""

import datetime as d
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortwise.checks import cohort_views as views
from cohortwise.checks.q_metrics import ALL_STAGED
from cohortwise.operators import joins, select
from cohortwise.plans import diagnoses, pathway
from cohortwise.plans.cohort import ID, LISTS, Cohort
from cohortwise.sources import io
from cohortwise.sources.fixtures import Source


def rows(df, columns=None):
    return Counter(map(tuple, df.select(sorted(columns or df.columns)).collect()))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def first_plans(spark):
    """Plans as first made, with broadcasts below 100 kB, as of tables a hundred times as large."""
    names = {"spark.sql.autoBroadcastJoinThreshold": "100k", "spark.sql.adaptive.enabled": "false"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    io.keep_places(spark)
    yield
    io.forget_places(spark)
    for n, v in before.items():
        spark.conf.set(n, v)


def checks(spark):
    return spark.range(3000).selectExpr(
        "concat('p', id % 400) AS ParticipantID", "'ORG01.zip' AS SubmittedZipFile", "id % 500 AS TransactionId", "id AS CSURowNumber",
        "date_add(DATE '2020-01-01', CAST(id % 3 AS INT)) AS ReceivedDate", "CAST(id % 5 AS STRING) AS LHC_Date")


def lists(spark):
    """Short lists out of long tables: unwritten, Spark takes them to be long."""
    long = spark.range(1_000_000)
    return {"excluded_transactions": long.filter("id % 250000 = 7").selectExpr("id % 500 AS TransactionId"),
            "excluded_people": long.filter("id % 250000 = 9").selectExpr("concat('p', id % 400) AS ParticipantID", "'TRUE' AS active")}


def test_records_are_moved_once_and_only_by_person(spark, first_plans):
    c = Cohort({"check": checks(spark)}, lists(spark), stage=io.staged(spark, LISTS))
    got = c.current("check")
    plan = plan_of(got)
    assert "SortMergeJoin" not in plan and plan.count("hashpartitioning(ParticipantID") == 1
    plain = Cohort({"check": checks(spark)}, lists(spark)).current("check")
    assert plan_of(plain).count("SortMergeJoin") == 2
    assert rows(got) == rows(plain) and got.count() == got.select(ID, "LHC_Date").distinct().count() > 0


def test_newest_records_are_the_same_wherever_they_meet(spark):
    some = checks(spark).withColumn("CSURowNumber", F.when(F.col("CSURowNumber") % 7 > 0, F.col("CSURowNumber")))
    twice = some.unionByName(some).unionByName(some.withColumn("SubmittedZipFile", F.lit("ORG00.zip")))
    keys = [ID, "LHC_Date"]
    assert rows(select.latest_per_key(twice, keys, home=ID)) == rows(select.latest_per_key(twice, keys))


def test_prior_events_and_repeats_stay_where_they_lie(spark, first_plans):
    made = lambda n, name, *c: io.save_bucketed(spark.range(n).selectExpr("CAST(id % 50 AS STRING) AS p", *c), io.fresh_path(spark, name), "p")
    events = made(2000, "e", "date_add(DATE '2020-01-01', CAST(id % 30 AS INT)) AS ed", "concat(id % 50, '#', id) AS eid", "CAST(id % 3 AS INT) AS o")
    outcomes = made(3000, "o", "date_add(DATE '2020-01-01', CAST(id % 31 AS INT)) AS od", "id AS oid", "CAST(id % 3 AS STRING) AS s")
    found = joins.prior_event(events, outcomes, "p", "eid", "ed", F.col("o"), "oid", "od", with_person=True)
    assert "Exchange hashpartitioning" not in plan_of(found) and found.count() > 0
    kept = select.drop_repeated_diagnoses(outcomes, "p", "od", "s", F.lit("m"), "oid", stage=lambda df: io.save_snapshot(df, io.fresh_path(spark, "r")))
    assert "Exchange hashpartitioning" not in plan_of(kept) and 0 < kept.count() < 3000


def test_a_diagnosis_key_of_two_people_is_linked_as_by_key_alone(spark):
    day = lambda n: d.date(2020, 1, n)
    events = spark.createDataFrame([("p", "p#1", day(1), "Invite date"), ("p", "p#2", day(5), "LHC Date high risk"), ("q", "q#1", day(2), "Invite date"), ("r", "r#1", None, None)],
                                   f"{ID} string, event_key string, date date, event string")
    found = spark.createDataFrame([("a", "p", day(6), "Lung"), ("a", "q", day(9), "Other"), ("b", "p", day(2), None), (None, "q", day(3), "Lung"), ("c", "q", day(1), "Lung")],
                                  f"pk string, {ID} string, diagnosis_date date, tumour_site_group string")
    got = pathway.link_diagnoses(events, found).select(ID, "event_key", "pk", "days_diff", "diagnosis_date", "tumour_site_group", "at_check_or_later").collect()
    assert Counter(map(tuple, got)) == Counter([
        ("p", "p#1", "b", 1, day(2), None, False), ("p", "p#2", "a", 1, day(6), "Lung", True), ("p", "p#2", "a", 1, day(9), "Other", True),
        ("q", "q#1", "a", 7, day(6), "Lung", False), ("q", "q#1", "a", 7, day(9), "Other", False), ("q", "q#1", None, 1, None, None, None),
        ("r", "r#1", None, None, None, None, None)])


def test_diagnoses_written_by_person_are_those_of_the_lazy_plan(spark, small):
    c = views.cohort(spark, small)
    groups = diagnoses.icd_groups(views.site_codes(spark))
    lazy = diagnoses.consolidate(c.raw["registry"], c.raw["rapid"], c.raw["pathway"], groups)
    columns = views.KEEP_EVENTS["diagnoses"]
    got = views.all_diagnoses(c, spark, columns)
    assert {"gender", "age_group"} < set(lazy.columns) and "age" not in got.columns
    assert rows(got, columns) == rows(lazy, columns) != Counter()


def test_an_empty_registry_leaves_no_diagnoses(spark, small):
    c = views.cohort(spark, small)
    c.raw = {n: c.raw[n].filter("DatasetId < 0") if n == "registry" else c.raw[n] for n in ("registry", "rapid", "pathway")}
    assert views.all_diagnoses(c, spark, views.KEEP_EVENTS["diagnoses"]).count() == 0


def test_rows_are_added_to_buckets(spark):
    stage = io.staged(spark)
    first = stage(spark.range(300).selectExpr("CAST(id % 30 AS STRING) AS k", "id AS x"), "first", "k")
    both = stage.append(first, spark.range(300, 350).selectExpr("id AS x", "CAST(id % 30 AS STRING) AS k"), "k")
    assert sorted(r.x for r in both.collect()) == list(range(350))
    io.keep_places(spark)
    try:
        got = both.groupBy("k").agg(F.count("*").alias("n"))
        assert "Exchange" not in plan_of(got)
        assert sum(r.n for r in got.collect()) == 350
    finally:
        io.forget_places(spark)


def test_views_of_shared_lines_have_the_same_rows(spark, small):
    shared, apart = Source(spark, small, shared=True), Source(spark, small)
    for name in ["fx_scan", "fx_diagnostics", "fx_registry", "fx_rapid", "fx_pathway", "fx_invite"]:
        assert rows(shared.fx(name)) == rows(apart.fx(name)) != Counter()
    assert "Join" not in shared.fx("fx_scan")._jdf.queryExecution().optimizedPlan().toString()


def test_all_metrics_read_no_raw_table_for_its_newest_transaction(spark, small):
    """The flags look at written records, so that none are made twice."""
    c = views.cohort(spark, small, ALL_STAGED, views.KEEP_METRICS)
    for base in ("checks", "scans", "diagnostics", "smoking", "invites", "measurements"):
        used = getattr(c, base).inputFiles()
        assert used and not [f for f in used if f.endswith(("lineitem.parquet", "orders.parquet"))]
