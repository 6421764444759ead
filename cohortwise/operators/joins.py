"""Lookups, nearest-date, as-of and closest-text joins, overlays and templates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions import text


def lookup(df: DataFrame, table: DataFrame, key: str, columns: dict[str, str] | Sequence[str],
           table_key: str | None = None) -> DataFrame:
    """Left join on one key to a lookup with one row per key (repeats are removed first).

    Whether the lookup is broadcast is left to Spark's size check.
    """
    columns = columns if isinstance(columns, dict) else {c: c for c in columns}
    right = (table.select(F.col(table_key or key).alias(key), *[F.col(c).alias(a) for c, a in columns.items()])
             .filter(F.col(key).isNotNull()).dropDuplicates([key]))
    return df.join(right, key, "left")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys of which a missing one equals a missing one; the right side's keys fill in where the left has no row."""
    renamed = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    both = left.join(renamed, on, how)
    if how in ("full", "right"):
        both = both.withColumns({k: F.coalesce(k, f"_{k}") for k in keys})
    return both.drop(*[f"_{k}" for k in keys])


def name_projects(df: DataFrame, names: DataFrame, org: str = "org_code", area: str = "ccg_code",
                  out: str = "project") -> DataFrame:
    """Project by submitter; areas that are reported apart take the area's name instead."""
    by_org = names.select(F.col("org_code").alias(org), "project_name_place").distinct()
    by_area = (names.filter("split_by_ccg = 1")
               .select(F.col("CCG_Code").alias(area), "project_name_ccg").distinct())
    return (df.join(by_org, org, "left").join(by_area, area, "left")
            .withColumn(out, F.coalesce("project_name_ccg", "project_name_place"))
            .drop("project_name_ccg", "project_name_place"))


def nearest_date_pairs(left: DataFrame, right: DataFrame, keys: Sequence[str], left_date: str, right_date: str,
                       within: int | None = None, direction: str = "both") -> DataFrame:
    """(keys, left_date, right_date, days): the closest right dates of every left date.

    Both sides are reduced to distinct dates per key, laid on one time line and matched
    by the last date before and the first date after: one shuffle, no pairs within a
    group, and a group is never longer than the calendar. Equally near dates are both kept.
    """
    l = left.select(*keys, F.col(left_date).alias("_d")).where(f"`{left_date}` IS NOT NULL").distinct()
    r = right.select(*keys, F.col(right_date).alias("_d")).where(f"`{right_date}` IS NOT NULL").distinct()
    line = l.withColumn("_l", F.lit(True)).unionByName(r.withColumn("_l", F.lit(False)))
    on = F.when(~F.col("_l"), F.col("_d"))
    # a right date on the same day sorts first, so that it counts as "on or before"
    order = [F.col("_d"), F.col("_l")]
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.last(on, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    found = line.withColumn("_before", before)
    if direction == "both":
        # the line read backwards: a running value again, where a frame up to the end would be built anew for each row
        back = Window.partitionBy(*keys).orderBy(F.desc("_d"), F.desc("_l"))
        after = F.last(on, ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, 0))
        found = found.withColumn("_after", after)
    else:
        found = found.withColumn("_after", F.lit(None).cast("date"))
    found = found.filter("_l").select(
        *keys, F.col("_d").alias(left_date),
        F.datediff("_d", "_before").alias("_db"), F.datediff("_after", "_d").alias("_da"), "_before", "_after")
    best = F.least("_db", "_da")
    hits = F.array_distinct(F.array_compact(F.array(
        F.when(F.col("_db") == best, F.col("_before")), F.when(F.col("_da") == best, F.col("_after")))))
    out = found.withColumn("days", best).filter(F.col("days").isNotNull())
    if within is not None:
        out = out.filter(F.col("days") <= within)
    return out.select(*keys, left_date, F.explode(hits).alias(right_date), "days")


def nearest_within(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, left_date: str,
                   right_id: str, right_date: str, within: int) -> DataFrame:
    """(left_id, right_id, days): right rows on the nearest date inside the window, ties kept."""
    pairs = nearest_date_pairs(left, right, keys, left_date, right_date, within)
    ids = left.select(left_id, *keys, left_date).distinct().join(pairs, [*keys, left_date])
    rights = right.select(*keys, right_date, right_id).distinct()
    return ids.join(rights, [*keys, right_date]).select(left_id, right_id, F.col("days").alias("days_difference")).distinct()


def prior_event(events: DataFrame, outcomes: DataFrame, person: str, event_id: str, event_date: str,
                event_order: Column, outcome_id: str, outcome_date: str, with_person: bool = False) -> DataFrame:
    """(outcome_id, event_id, days_diff): nearest event on or before each outcome, if asked for with the person.

    Events of one day count as one, the first in event order. A person's days with an event, never more than the calendar has, meet
    the person's outcomes as one row, and an outcome takes the last of them: rows that lie by person stay there.
    """
    w = F.struct(event_order.alias("o"), F.col(event_id).alias("i"))
    per_day = (events.filter(F.col(event_date).isNotNull())
               .groupBy(person, event_date).agg(F.min(w).alias("_w"))
               .select(person, F.struct(F.col(event_date).alias("d"), F.col("_w.i").alias("i")).alias("_e")))
    days = per_day.groupBy(person).agg(F.collect_list("_e").alias("_es"))
    last = F.array_max(F.filter("_es", lambda e: e["d"] <= F.col(outcome_date)))
    return (outcomes.select(outcome_id, person, outcome_date).distinct().join(days, person)
            .withColumn("_f", last).filter("_f IS NOT NULL")
            .select(outcome_id, *[person] * with_person, F.col("_f.i").alias(event_id), F.datediff(outcome_date, "_f.d").alias("days_diff")))


def closest_terms(df: DataFrame, token: str, terms: Sequence[str], stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Adds (term, distance) of the closest accepted term to every token.

    Distances are computed once per distinct token; the terms are a constant array, so
    no pairs of rows are formed. Lengths and letter counts bound each distance from below;
    only terms that can still be the closest are compared character by character.

    ``stage`` writes the scored tokens, so that Spark knows their size before it plans the join: few are broadcast, and the
    rows stay where they are.
    """
    letters = "".join(sorted({c for t in terms for c in t}))
    bounds = F.array(*[F.struct(text.least_distance(F.col("_letters"), F.length(token), t, letters).alias("least"), F.lit(t).alias("term")) for t in terms])
    scored = (df.select(token).filter(F.col(token).isNotNull()).distinct()
              .withColumn("_letters", text.letter_counts(F.col(token), letters)).withColumn("_bounds", bounds)
              .withColumn("_best", F.explode(text.closest_of(F.col(token), F.col("_bounds"))))
              .select(token, F.col("_best.term").alias("term"), F.col("_best.distance").alias("distance")))
    return df.join(stage(scored) if stage else scored, token)


def two_stage_lookup(df: DataFrame, code: str, full: DataFrame, short: DataFrame, value: str) -> DataFrame:
    """Value by the full code, else by the short code. Missing codes match nothing."""
    a = full.filter(F.col(code).isNotNull()).select(code, F.col(value).alias("_full")).distinct()
    b = short.filter(F.col(code).isNotNull()).select(code, F.col(value).alias("_short")).distinct()
    return (df.join(a, code, "left").join(b, code, "left")
            .withColumn(value, F.coalesce("_full", "_short")).drop("_full", "_short"))


def overlay(df: DataFrame, adjustments: DataFrame, keys: Sequence[str], value: str, adjusted: str) -> DataFrame:
    """Adjusted value wins; the comment keeps what it replaced."""
    return (df.join(adjustments.select(*keys, adjusted), list(keys), "left")
            .withColumn("comment", F.when(F.col(adjusted).isNotNull(), F.concat(
                F.lit("Manual adjustment, original data was "), F.coalesce(F.col(value).cast("string"), F.lit("NA")))))
            .withColumn(value, F.coalesce(adjusted, value)).drop(adjusted))


def template(projects: DataFrame, metrics: Sequence[str], start: str, end: str) -> DataFrame:
    """Every project with every metric and month.

    Metrics and months are constant arrays, unfolded row by row: no join at all.
    """
    months = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 month"))
    return (projects.withColumn("metric_id", F.explode(F.array(*[F.lit(m) for m in metrics])))
            .withColumn("month", F.explode(months)))


def filtered_versus_all(everyone: DataFrame, chosen: DataFrame, key: str, share: str) -> DataFrame:
    a = everyone.select(key, F.col("n").alias("all_n"), F.col(share).alias("all_p"))
    b = chosen.select(key, F.col("n").alias("filtered_n"), F.col(share).alias("filtered_p"))
    return (a.join(b, a[key].eqNullSafe(b[key]), "left").drop(b[key])
            .withColumn("difference_p", F.round(F.col("filtered_p") - F.col("all_p"), 4)))
