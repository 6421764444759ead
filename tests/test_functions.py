"""Literal-row tests of the column expressions."""

import datetime as d

import pytest
from pyspark.sql import functions as F

from cohortwise.functions import clean, dates, text


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("raw,expected", [
    ("01/01/2022", d.date(2022, 1, 1)),
    ("01/02/2022 10:30", d.date(2022, 2, 1)),
    ("Mar 1 2022 11:30", d.date(2022, 3, 1)),
    ("01-04-22", d.date(2022, 4, 1)),
    ("2022-05-01 00:00:00", d.date(2022, 5, 1)),
    ("20220101", d.date(2022, 1, 1)),
    ("25-Aug-21", d.date(2021, 8, 25)),
    ("25-AUG-21", d.date(2021, 8, 25)),
    ("45254", d.date(2023, 11, 24)),
    ("44971", d.date(2023, 2, 14)),
    ("Attended", None), ("abcde", None), ("31/02/2022", None), ("", None), (None, None),
])
def test_parse_date(spark, raw, expected):
    assert one(spark, raw, dates.parse_date) == expected


@pytest.mark.parametrize("start,end,months", [
    ("2024-01-31", "2024-02-29", 0), ("2024-01-31", "2024-03-31", 2), ("2024-01-15", "2024-02-15", 1),
    ("2024-02-15", "2024-01-15", -1), ("2024-02-15", "2024-01-16", 0), ("2023-12-01", "2024-12-01", 12)])
def test_complete_months(spark, start, end, months):
    df = spark.createDataFrame([(start, end)], "a string, b string").select(
        dates.complete_months(F.col("a").cast("date"), F.col("b").cast("date")).alias("m"))
    assert df.first().m == months


def test_financial_year_and_include(spark):
    df = spark.createDataFrame([("2023-03-31",), ("2023-04-01",), ("1999-12-01",)], "v string").withColumn("v", F.col("v").cast("date"))
    assert [r.y for r in df.select(dates.financial_year("v").alias("y")).collect()] == ["2022-23", "2023-24", "1999-00"]
    assert [r.y for r in df.select(dates.include_label("v", "2023-05-02").alias("y")).collect()] == ["Exclude", "Exclude", "Exclude"]


def test_first_match_only(spark):
    assert one(spark, "1..2..3", lambda c: clean.replace_first(c, r"\.{2}", ".")) == "1.2..3"
    assert one(spark, "55yrsyrs", lambda c: clean.replace_first(c, "yrs", "")) == "55yrs"


@pytest.mark.parametrize("raw,value", [("0.45", 0.45), (" 1.5 ", 1.5), ("1.5d", None), ("IA2", None), ("NaN", None), ("", None), ("-3e2", -300.0)])
def test_to_number(spark, raw, value):
    assert one(spark, raw, clean.to_number) == value


def test_bins_are_right_closed(spark):
    label = lambda v: one(spark, v, lambda c: clean.cut(c, [-1, 49, 59], ["below", "0-49", "50-59", "60+"], "Not known"), "double")
    assert [label(v) for v in (-1.0, -0.5, 49.0, 49.5, 59.0, 59.1, None)] == ["below", "0-49", "0-49", "50-59", "50-59", "60+", "Not known"]


def test_recode_keeps_missing_and_others(spark):
    assert one(spark, None, lambda c: clean.recode(c, {"YES": ["Y"]}, "Other")) is None
    assert one(spark, "Z", lambda c: clean.recode(c, {"YES": ["Y"]}, "Other")) == "Other"
    assert one(spark, "Z", lambda c: clean.recode(c, {"YES": ["Y"]})) == "Z"


def test_not_in_keeps_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    assert df.filter(~clean.one_of("v", ["a"])).count() == 2


def test_swap_repair(spark):
    df = spark.createDataFrame([("01/01/2022", "Attended"), ("Attended", "01/01/2022"), (None, "Attended")], "a string, b string")
    date, word = clean.swap_repair("a", "b", dates.parse_date)
    rows = [tuple(r) for r in df.select(date, word).collect()]
    assert rows == [(d.date(2022, 1, 1), "Attended"), (d.date(2022, 1, 1), "Attended"), (None, "Attended")]


def test_split_findings(spark):
    got = one(spark, "thyroid lesionCoronary calcification-a - b. c", text.split_findings)
    assert got == ["thyroid lesion", "coronary calcification", "a", "b", "c"]


def jaro(a, b):
    if not a or not b:
        return 0.0 if a == b else 1.0
    band, used, taken = max(max(len(a), len(b)) // 2 - 1, 0), [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - band), min(len(b), i + band + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                taken.append(ch)
                break
    m = len(taken)
    if not m:
        return 1.0
    t = sum(x != y for x, y in zip(taken, [c for c, u in zip(b, used) if u])) // 2
    return 1 - (m / len(a) + m / len(b) + (m - t) / m) / 3


def test_jaro_against_brute_force(spark):
    words = ["martha", "marhta", "dixon", "dicksonx", "renal lesions", "adrenal lesions", "abcvwxyz", "cabvwxyz", "ila", "a", ""]
    pairs = [(x, y) for x in words for y in words]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", text.jaro_distance(F.col("a"), F.col("b")).alias("d")).collect()
    for r in got:
        assert abs(r.d - jaro(r.a, r.b)) < 1e-12, (r.a, r.b)


def test_nearest_terms_keeps_ties(spark):
    best = one(spark, "ab", lambda c: text.nearest_terms(c, ["abx", "aby", "zzz"]))
    assert sorted(b.term for b in best) == ["abx", "aby"]


def test_rounding(spark):
    assert one(spark, 12, clean.round_to, "int") == 10
    assert one(spark, 13, clean.round_to, "int") == 15
    assert [one(spark, v, clean.hide_small, "int") for v in (9, 10)] == ["<10", "10"]
