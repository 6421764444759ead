"""Matching behind a bound, listings, broken rows, snapshots by month, orders by frequency."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.functions import text
from cohortwise.operators import joins, select
from cohortwise.plans import pathway, tables
from cohortwise.sources import io

TERMS = ["consolidation", "tuberculosis", "mediastinal mass", "coronary calcification", "renal lesions", "ila", "a"]


def test_bounded_terms_are_those_of_all_distances(spark):
    rng = random.Random(2)
    tokens = ["", "a", "ila", "xyz", "mass", "zzzz", None]
    for t in TERMS:
        for _ in range(12):
            x = list(t)
            for _ in range(rng.randint(0, 4)):
                i = rng.randrange(len(x) + 1)
                x[i:i + rng.randint(0, 1)] = rng.choice(["", "e", " ", "ab"])
            tokens.append("".join(x))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, token string")
    got = sorted((r.i, r.term, r.distance) for r in joins.closest_terms(df, "token", TERMS).collect())
    every = df.filter("token IS NOT NULL").select("i", F.explode(text.nearest_terms(F.col("token"), TERMS)).alias("b"))
    assert got == sorted((r.i, r.b.term, r.b.distance) for r in every.collect())


def test_least_distance_is_a_bound(spark):
    rng = random.Random(3)
    letters = "".join(sorted(set("".join(TERMS))))
    tokens = ["".join(rng.choices(letters + "#", k=rng.randint(0, 20))) for _ in range(150)]
    df = spark.createDataFrame([(t,) for t in tokens], "t string").withColumn("n", text.letter_counts(F.col("t"), letters))
    for term in TERMS:
        pair = df.select(text.least_distance(F.col("n"), F.length("t"), term, letters).alias("least"), text.jaro_distance(F.col("t"), F.lit(term)).alias("d"))
        assert pair.filter("least > d + 1e-12").count() == 0


def test_snapshot_by_month_reads_the_months_asked_for(spark):
    rows = spark.createDataFrame([("f", f"2024-{m:02d}-{d:02d}", m) for m in range(1, 9) for d in (1, 20)], "SubmittedFile string, r string, TransactionId int").select(
        "SubmittedFile", F.col("r").cast("date").alias("ReceivedDate"), "TransactionId")
    snapshot = io.save_by_month(rows, io.fresh_path(spark, "by_month"))
    recent = select.recent_from_months(snapshot, "2024-06-10", ["SubmittedFile", "ReceivedDate", "TransactionId"])
    assert sorted(map(tuple, recent.collect())) == sorted(map(tuple, select.recent_headers(rows, "2024-06-10", recent.columns).collect()))
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(received_month" in plan


def test_listing_reads_no_content(spark):
    out = io.fresh_path(spark, "listed")
    spark.range(6).withColumn("k", F.col("id") % 3).write.partitionBy("k").csv(out)
    listed = io.list_files(spark, out)
    assert listed.count() >= 3 and listed.columns == ["path", "length", "modified"]
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString()


def test_broken_rows_are_kept_and_flagged(spark):
    out = io.fresh_path(spark, "broken")
    spark.createDataFrame([("metric_id,numerator",), ("1a,5",), ("1a,five",), ("zz,0",), ("1a,",), ("1a,1,extra",)], "value string").coalesce(1).write.text(out)
    rows = io.row_flags(io.read_checked(spark, out, io.text_schema(["metric_id", "numerator"], {"numerator": T.DoubleType()})),
                        ["1a"], "broken_row")
    got = sorted((r.metric_id, r.numerator, r.dq_broken, r.dq_problem) for r in rows.fillna(-1.0, ["numerator"]).collect())
    assert got == [("1a", -1.0, False, True), ("1a", -1.0, True, True), ("1a", 1.0, True, True), ("1a", 5.0, False, False), ("zz", 0.0, False, True)]


def test_order_by_frequency(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "v string")
    got = tables.order_by_frequency(df, "v", "place", "Not known")
    assert {(r.v, r.place) for r in got.collect()} == {("b", 1), ("a", 2), ("c", 3), ("Not known", 4)} and got.count() == 7
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert tables.order_by_frequency(df.limit(0), "v", "place").collect() == []


def test_one_pass_measures_equal_those_of_each_group(spark):
    columns = "invite_1 string, invite_2 string, invite_3 string, attendance string, methods string, risk string, scan_group string, cancer_outcome string, cancer_stage string, " \
              "check_before_end_185 boolean, imd_decile int, age_band_eval string, ethnic_group string, triage_before_risk_assessment string, admin string, sex string, CAName string, participants long"
    rng = random.Random(5)
    rows = [("Invite 1", None, None, rng.choice(["LHC Attended", "LHC DNA"]), rng.choice(["F2F", "Virtual"]), rng.choice(["High risk", None]), rng.choice(["1 x scan", None]), None, None,
             True, rng.randint(1, 10), rng.choice(["55-64", "75", "Other"]), "White", "Unknown", "Unknown", rng.choice(["Female", None]), "A", rng.randint(1, 9)) for _ in range(60)]
    cube = spark.createDataFrame(rows, columns)
    groupings = {"deprivation": "rpt_imd", "age": "rpt_age", "gender": "sex", "admin": "rpt_admin"}
    got = {(r.grouping, r.level): r.asDict() for r in pathway.measures_by_group(cube, groupings).collect()}
    want = {}
    for g, c in groupings.items():
        for r in pathway.group_measures(pathway.reporting_groups(cube), c).collect():
            want[g, r[c]] = {k: v for k, v in r.asDict().items() if k != c}
    for k, v in want.items():
        assert {m: x for m, x in got[k].items() if m not in ("grouping", "level")} == v
    assert set(got) == {*want, ("total", "Total")} and ("admin", "Not known") in want
