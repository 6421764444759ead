"""Counts, medians, shares, subtotals, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.clean import ratio

# Metrics that are medians of days and are never added up.
MEDIAN_METRICS = ["10", "11", "12", "13"]


def distinct_people(df: DataFrame, by: Sequence[str], person: str = "ParticipantID",
                    out: str = "numerator") -> DataFrame:
    """Distinct people per group. The person is part of the first shuffle key, so one
    large project or month is counted by many tasks."""
    return df.groupBy(*by).agg(F.countDistinct(person).alias(out))


def median_days(df: DataFrame, by: Sequence[str], value: str, out: str = "numerator") -> DataFrame:
    """Exact, interpolated median. Day counts repeat, so the buffers hold few values."""
    return df.groupBy(*by).agg(F.median(value).alias(out))


def conditional_sums(df: DataFrame, by: Sequence[str], weight: str, measures: Mapping[str, Column]) -> DataFrame:
    sums = [F.coalesce(F.sum(F.when(cond, F.col(weight))), F.lit(0)).cast("bigint").alias(name)
            for name, cond in measures.items()]
    return df.groupBy(*by).agg(*sums)


def share_of_total(df: DataFrame, field: str, weight: str, milestone: str) -> DataFrame:
    """Weighted count per response and its share of everyone (a scalar subquery)."""
    total = df.select(F.sum(weight)).scalar()
    return (df.groupBy(F.col(field).cast("string").alias("response"))
            .agg(F.sum(weight).cast("bigint").alias("n"))
            .select("response", "n", F.round(100.0 * F.col("n") / total, 1).alias("n_perc"),
                    F.lit(milestone).alias("milestone")))


def milestone_shares(df: DataFrame, weight: str, fields: Mapping[str, Column]) -> DataFrame:
    """share_of_total of several fields from one scan: the fields become rows first."""
    total = df.select(F.sum(weight)).scalar()
    rows = F.array(*[F.struct(F.lit(m).alias("milestone"), c.cast("string").alias("response"))
                     for m, c in fields.items()])
    return (df.select(weight, F.explode(rows).alias("_r"))
            .groupBy("_r.milestone", "_r.response").agg(F.sum(weight).cast("bigint").alias("n"))
            .select("milestone", "response", "n", F.round(100.0 * F.col("n") / total, 1).alias("n_perc")))


def segment_ratios(df: DataFrame, segments: Mapping[str, Column], weight: str, base: Column, hit: Column) -> DataFrame:
    """base, hit and hit/base for many overlapping segments in one pass."""
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in segments.items()]))
    return (conditional_sums(df.withColumn("segment", F.explode(names)), ["segment"], weight,
                             {"base": base, "hit": hit})
            .withColumn("conversion", ratio("hit", "base", 4)))


def collapse_person(df: DataFrame, person: str, out: str = "participants") -> DataFrame:
    """Group by everything but the person; the record level stops here."""
    return df.groupBy(*[c for c in df.columns if c != person]).agg(F.countDistinct(person).alias(out))


def sum_or_median(df: DataFrame, by: Sequence[str], metric: str = "metric_id", value: str = "numerator",
                  strict: bool = False) -> DataFrame:
    """Median for the day metrics, sum for the rest.

    strict: a missing input makes the sum and the median missing; otherwise it is skipped.
    """
    missing = F.count(F.when(F.col(value).isNull(), 1)) > 0
    total, middle = F.coalesce(F.sum(value), F.lit(0)).cast("double"), F.median(value)
    if strict:
        total, middle = F.when(~missing, F.sum(value).cast("double")), F.when(~missing, F.median(value))
    return (df.groupBy(*by).agg(total.alias("_sum"), middle.alias("_median"))
            .withColumn(value, F.when(F.col(metric).isin(MEDIAN_METRICS), F.col("_median")).otherwise(F.col("_sum")))
            .drop("_sum", "_median"))


def subtotals(df: DataFrame, by: Sequence[str], value: str, label: str = "Total") -> DataFrame:
    """Rows for each combination, each leading part of it, and everything; missing parts are labelled."""
    rolled = df.rollup(*by).agg(F.sum(value).cast("bigint").alias(value),
                                *[F.grouping(c).alias(f"_g{i}") for i, c in enumerate(by)])
    return rolled.select(*[F.when(F.col(f"_g{i}") == 1, label).otherwise(F.col(c)).alias(c)
                           for i, c in enumerate(by)], value)


def pivot_with_totals(df: DataFrame, row: str, column: str, values: Sequence[str], count: Column,
                      label: str = "Total") -> DataFrame:
    """Wide table with a total row and column; the column values are given, so one job suffices."""
    wide = df.groupBy(row).pivot(column, list(values)).agg(count)
    wide = wide.select(row, *[F.coalesce(F.col(f"`{v}`"), F.lit(0)).cast("bigint").alias(v) for v in values])
    wide = wide.withColumn(label, reduce(lambda a, b: a + b, [F.col(f"`{v}`") for v in values]))
    total = wide.groupBy().agg(*[F.sum(f"`{c}`").cast("bigint").alias(c) for c in [*values, label]])
    return wide.unionByName(total.select(F.lit(label).alias(row), *[F.col(f"`{c}`") for c in [*values, label]]))


def funnel(steps: Sequence[tuple[str, DataFrame]], person: str = "ParticipantID") -> DataFrame:
    """Distinct people after each step and their percentage of the first step, in one aggregate."""
    frames = [f.select(person).withColumn("step_no", F.lit(i)).withColumn("step", F.lit(name))
              for i, (name, f) in enumerate(steps, 1)]
    counts = reduce(DataFrame.unionByName, frames).groupBy("step_no", "step").agg(
        F.countDistinct(person).alias("people"))
    first = counts.filter("step_no = 1").select(F.max("people")).scalar()
    return counts.withColumn("perc", F.round(100.0 * F.col("people") / first, 2))


def flag_funnel(df: DataFrame, steps: Mapping[str, Column], person: str) -> DataFrame:
    """Funnel over flags of one table: every step needs the ones before it."""
    passed, so_far = [], F.lit(True)
    for i, (name, cond) in enumerate(steps.items(), 1):
        so_far = so_far & cond
        passed.append(F.when(so_far, F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"))))
    counts = (df.select(person, F.explode(F.array_compact(F.array(*passed))).alias("_s"))
              .groupBy("_s.step_no", "_s.step").agg(F.countDistinct(person).alias("people")))
    first = counts.filter("step_no = 1").select(F.max("people")).scalar()
    return counts.withColumn("perc", F.round(100.0 * F.col("people") / first, 2))


def profile(df: DataFrame, skip: Sequence[str] = (), skip_prefix: str | None = None) -> DataFrame:
    """Rows, missing and distinct values of each column, from one scan.

    Columns become (variable, value) rows that are counted per value first, so wide
    tables do not repeat the scan and frequent values collapse before the shuffle.
    """
    fields = [f for f in df.schema.fields
              if f.name not in skip and not (skip_prefix and f.name.startswith(skip_prefix))]
    cells = F.array(*[F.struct(F.lit(f.name).alias("variable"), F.lit(f.dataType.simpleString()).alias("class"),
                               F.col(f"`{f.name}`").cast("string").alias("value")) for f in fields])
    return (df.select(F.explode(cells).alias("_c"))
            .groupBy("_c.variable", "_c.class", "_c.value").agg(F.count(F.lit(1)).alias("_n"))
            .groupBy("variable", "class")
            .agg(F.sum("_n").alias("rows"),
                 F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_n"))), F.lit(0)).alias("missing"),
                 F.count("value").alias("cardinality"))
            .withColumn("missing_rate", ratio("missing", "rows", 6))
            .withColumn("cardinality_rate", ratio("cardinality", "rows", 6)))


def list_and_mode(df: DataFrame, key: str, value: str) -> DataFrame:
    """Sorted list of values and the most frequent one (first by name on ties) per key."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(key).agg(
        F.array_join(F.array_sort(F.collect_list(value)), ", ").alias("values_list"),
        F.min(F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v"))).getField("v").alias("mode"))


def new_data_flag(df: DataFrame, group: str, month: str = "month", value: str = "numerator") -> DataFrame:
    """Does the group's last month with any data equal the last month of all?"""
    last = df.select(F.max(month)).scalar()
    monthly = df.groupBy(group, month).agg(F.sum(value).alias("_t")).filter("_t > 0")
    return monthly.groupBy(group).agg(F.max(month).alias("_m")).select(group, (F.col("_m") == last).alias("new_data"))
