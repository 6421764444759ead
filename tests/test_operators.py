"""Operators against brute force on small random data, with one key holding most rows."""

import datetime as d
import random

import pytest
from pyspark.sql import functions as F

from cohortwise.operators import aggregate, joins, reshape, select, windows

DAY = d.date(2022, 1, 1)


def skewed(n, seed, people=6):
    rnd = random.Random(seed)
    return [(("hot" if rnd.random() < 0.4 else f"p{rnd.randrange(people)}"), DAY + d.timedelta(rnd.randrange(120)), f"{seed}-{i}") for i in range(n)]


def test_latest_per_key_is_unique_and_repeatable(spark):
    rows = [("a", d.date(2024, 1, 1), 1, "x"), ("a", d.date(2024, 1, 2), 1, "y"), ("a", d.date(2024, 1, 2), 2, "z"), ("a", d.date(2024, 1, 2), 2, "b"), (None, None, 1, "n")]
    df = spark.createDataFrame(rows, "k string, ReceivedDate date, CSURowNumber int, v string")
    got = [sorted((r.k or "", r.v) for r in select.latest_per_key(df.repartition(n), ["k"]).collect()) for n in (1, 3)]
    assert got[0] == got[1] == [("", "n"), ("a", "b")]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.current_date().alias("ReceivedDate"), F.col("id").alias("CSURowNumber"))
    plan = select.latest_per_key(df, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("WindowGroupLimit") > plan.index("Exchange")


def test_exclusion_drops_missing_keys_unless_kept(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    listed = spark.createDataFrame([(1,), (None,)], "k int")
    assert [r.k for r in select.exclude_listed(df, listed, "k").collect()] == [2]
    assert sorted(str(r.k) for r in select.exclude_listed(df, listed, "k", keep_missing=True).collect()) == ["2", "None"]


@pytest.mark.parametrize("within", [3, 15, 90])
def test_nearest_within_against_brute_force(spark, within):
    left, right = skewed(80, 1), skewed(80, 2)
    l = spark.createDataFrame(left, "p string, ld date, lid string")
    r = spark.createDataFrame(right, "p string, rd date, rid string")
    got = {tuple(x) for x in joins.nearest_within(l, r, ["p"], "lid", "ld", "rid", "rd", within).collect()}
    want = set()
    for p, ld, lid in left:
        gaps = [(abs((rd - ld).days), rid) for q, rd, rid in right if q == p and abs((rd - ld).days) <= within]
        want |= {(lid, rid, g) for g, rid in gaps if g == min(x for x, _ in gaps)}
    assert got == want


def test_prior_event_against_brute_force(spark):
    events, outcomes = skewed(90, 3), skewed(60, 4)
    e = spark.createDataFrame(events, "p string, ed date, eid string").withColumn("o", F.length("eid"))
    o = spark.createDataFrame(outcomes, "p string, od date, oid string")
    got = {tuple(x) for x in joins.prior_event(e, o, "p", "eid", "ed", F.col("o"), "oid", "od").collect()}
    want = set()
    for p, od, oid in outcomes:
        before = [((od - ed).days, len(eid), eid) for q, ed, eid in events if q == p and ed <= od]
        if before:
            g, _, eid = min(before)
            want.add((oid, eid, g))
    assert got == want


def test_drop_repeated_against_brute_force(spark):
    rnd = random.Random(5)
    rows = [(p, day, rnd.choice("AB"), rnd.choice("xy"), i) for p, day, i in skewed(150, 6, 3)]
    df = spark.createDataFrame(rows, "p string, d date, s string, m string, k string")
    got = {r.k for r in select.drop_repeated_diagnoses(df, "p", "d", "s", F.col("m"), "k").collect()}
    want, last = set(), None
    for row in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3], r[4])):
        same = last and last[0] == row[0] and last[2] != row[2] and last[3] == row[3] and (row[1] - last[1]).days < 100
        if not same:
            want.add(row[4])
        last = row
    assert got == want and len(got) < len(rows)


def test_newest_and_latest(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c")], "DatasetId int, v string")
    assert {r.v for r in select.newest_snapshot(df).collect()} == {"b", "c"}
    rows = [("x", d.date(2024, 1, 1)), ("x", d.date(2024, 1, 5)), (None, d.date(2024, 1, 2))]
    got = select.latest_submission(spark.createDataFrame(rows, "g string, ReceivedDate date"), "g")
    assert {tuple(r) for r in got.collect()} == {("x", d.date(2024, 1, 5)), (None, d.date(2024, 1, 2))}


def test_ranked_first_keeps_ties(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 2, "z")], "k string, o int, v string")
    assert {r.v for r in select.ranked_first(df, ["k"], [F.col("o")]).collect()} == {"x", "y"}


def test_transaction_validity(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1), ("B", 9)], "org_code string, TransactionId int")
    got = {(r.org_code, r.TransactionId): r.transaction_validity for r in select.transaction_validity(df, "A", [9]).collect()}
    assert got == {("A", 1): "Invalid", ("A", 2): "Valid", ("B", 1): "Valid", ("B", 9): "Invalid"}


def test_two_stage_lookup(spark):
    df = spark.createDataFrame([("C341",), ("C34",), ("X",), (None,)], "c string")
    full = spark.createDataFrame([("C341", "full"), (None, "never")], "c string, g string")
    short = spark.createDataFrame([("C34", "short"), ("C341", "late")], "c string, g string")
    assert {(r.c, r.g) for r in joins.two_stage_lookup(df, "c", full, short, "g").collect()} == {
        ("C341", "full"), ("C34", "short"), ("X", None), (None, None)}


def test_overlay_and_template(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, n double")
    adj = spark.createDataFrame([("a", 9.0)], "k string, x double")
    got = {r.k: (r.n, r.comment) for r in joins.overlay(df, adj, ["k"], "n", "x").collect()}
    assert got == {"a": (9.0, "Manual adjustment, original data was 1.0"), "b": (2.0, None)}
    t = joins.template(df, ["m1", "m2"], "2022-01-01", "2022-03-01")
    assert t.count() == 12 and "Join" not in t._jdf.queryExecution().executedPlan().toString()


def test_strict_sum_carries_missing(spark):
    df = spark.createDataFrame([("1a", 1.0), ("1a", None), ("2", 3.0), ("10", 1.0), ("10", 2.0)], "metric_id string, numerator double")
    strict = {r.metric_id: r.numerator for r in aggregate.sum_or_median(df, ["metric_id"], strict=True).collect()}
    loose = {r.metric_id: r.numerator for r in aggregate.sum_or_median(df, ["metric_id"]).collect()}
    assert strict == {"1a": None, "2": 3.0, "10": 1.5} and loose == {"1a": 1.0, "2": 3.0, "10": 1.5}


def test_pivot_totals_add_up(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 3), ("b", "x", 4)], "r string, c string, p int")
    rows = {r["r"]: r.asDict() for r in aggregate.pivot_with_totals(df, "r", "c", ["x", "y"], F.countDistinct("p")).collect()}
    assert rows["Total"]["Total"] == 4 and rows["a"]["Total"] == 2 and rows["b"]["y"] == 0


def test_subtotals_and_profile(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", None, 2)], "g string, h string, n int")
    got = {(r.g, r.h): r.n for r in aggregate.subtotals(df, ["g", "h"], "n").collect()}
    assert got == {("a", "x"): 1, ("a", None): 2, ("a", "Total"): 3, ("Total", "Total"): 3}
    prof = {r.variable: (r.rows, r.missing, r.cardinality) for r in aggregate.profile(df).collect()}
    assert prof == {"g": (2, 0, 1), "h": (2, 1, 1), "n": (2, 0, 2)}


def test_funnel_never_grows(spark):
    rows = spark.range(50).select((F.col("id") % 10).alias("p"), F.col("id"))
    got = aggregate.flag_funnel(rows, {"all": F.lit(True), "some": F.col("p") < 6, "few": F.col("id") < 4}, "p").orderBy("step_no").collect()
    assert [r.people for r in got] == [10, 6, 4] and got[0].perc == 100.0


def test_shapes(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0)], "k string, n int")
    assert [r.k for r in reshape.uncount(df, "n").collect()] == ["a"] * 3
    wide = reshape.to_wide(df, ["k"], "n", [0, 3], F.count("k"), fill=0, prefix="n_")
    assert {tuple(r) for r in wide.collect()} == {("a", 0, 1), ("b", 1, 0)}
    both = reshape.union_all([df, spark.createDataFrame([("c", 1.5)], "k string, x double")])
    assert set(both.columns) == {"k", "n", "x"} and both.count() == 3


def test_sequence_sees_dates_not_rows(spark):
    rows = [("hot", DAY)] * 500 + [("hot", DAY + d.timedelta(3)), ("a", DAY)]
    got = {(r.p, r.d): (r.sequence, r.previous) for r in windows.sequence_dates(spark.createDataFrame(rows, "p string, d date"), "p", "d").collect()}
    assert got == {("hot", DAY): (1, None), ("hot", DAY + d.timedelta(3)): (2, DAY), ("a", DAY): (1, None)}


def test_missing_keys_are_keys(spark):
    from cohortwise.operators import windows
    from cohortwise.plans import reports
    rows = spark.createDataFrame([("a", "x", 1.0), (None, "x", 2.0), (None, None, 3.0)], "project string, metric_id string, numerator double")
    assert sorted((r.project or "", r.n) for r in windows.add_count(rows, ["project"]).collect()) == [("", 2), ("", 2), ("a", 1)]
    full = reshape.complete(rows, ["project"], ["metric_id"], "numerator", fill=0.0)
    assert {(r.project, r.metric_id): r.numerator for r in full.collect()} == {("a", "x"): 1.0, ("a", None): 0.0, (None, "x"): 2.0, (None, None): 3.0}
    flat = spark.createDataFrame([(None, "2023-01-01", "invited_first", 5.0)], "Project string, month string, measure string, Numerator double")
    assert [tuple(r) for r in reports.report_difference(flat, flat).collect()] == [(None, "2023-01-01", "invited_first", 5.0, 5.0, 0.0)]
    counts = spark.createDataFrame([("1a", "sex", None, "Female", 3)], "metric_id string, demographic string, project string, demographic_value string, participants long")
    assert [r.participants for r in reports.demographic_flatfile(counts).collect()] == [3]


def test_nearest_dates_of_one_key_with_many_dates(spark):
    import datetime as d
    start = d.date(1970, 1, 1)
    left = spark.createDataFrame([("p", start + d.timedelta(days=3 * i)) for i in range(20_000)], "k string, a date")
    right = spark.createDataFrame([("p", start + d.timedelta(days=7 * i)) for i in range(5_000)], "k string, b date")
    pairs = joins.nearest_date_pairs(left, right, ["k"], "a", "b")
    got = {(r.a - start).days: r.days for r in pairs.select("a", "days").distinct().collect()}
    last = 7 * 4_999
    assert got == {x: min(x % 7, 7 - x % 7) if x < last else x - last for x in range(0, 60_000, 3)}
    assert "unboundedfollowing" not in pairs._jdf.queryExecution().executedPlan().toString()


def test_financial_years_of_a_range():
    from cohortwise.plans import reports
    assert reports.fin_years("2019-04-01", "2024-03-01") == ["2019-20", "2020-21", "2021-22", "2022-23", "2023-24"]
    assert reports.fin_years("2019-03-01", "2019-04-01") == ["2018-19", "2019-20"]
