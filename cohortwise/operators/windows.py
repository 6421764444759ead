"""Ordered history per person. Dates are reduced to distinct ones first, so that a
person's window is never longer than the calendar, however many rows the person has."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions import clean, dates
from cohortwise.operators import joins

# Upper bounds of the days from the first scan, and their categories.
SCAN_BOUNDS = [-1, 1, 61, 152, 335, 456, 669, 791, 1400, 1521]
SCAN_CATEGORIES = [
    "Not classified",
    "Initial scan",
    "Not classified",
    "3 month follow-up scan",
    "Not classified",
    "12 month follow-up scan",
    "Not classified",
    "24 month follow-up scan",
    "2-year+ nodule surveillance",
    "48 month follow-up scan",
    "2-year+ nodule surveillance",
]


def sequence_dates(df: DataFrame, person: str, date: str) -> DataFrame:
    """(person, date, sequence, previous): distinct dates numbered per person."""
    w = Window.partitionBy(person).orderBy(date)
    return (df.select(person, date).filter(F.col(date).isNotNull()).distinct()
            .withColumn("sequence", F.row_number().over(w))
            .withColumn("previous", F.lag(date).over(w)))


def first_event_date(df: DataFrame, person: str, date: str, counts) -> DataFrame:
    return (df.filter(counts & F.col(date).isNotNull())
            .groupBy(person).agg(F.min(date).alias("first_date")))


def scan_category(days) -> "F.Column":
    return clean.cut(days, SCAN_BOUNDS, SCAN_CATEGORIES)


def event_run_id(df: DataFrame, person: str, date: str, event: str) -> DataFrame:
    """Running number of each distinct (date, event) of a person, as a key with the person."""
    w = Window.partitionBy(person).orderBy(F.col(date).asc_nulls_first(), F.col(event).asc_nulls_first())
    runs = df.select(person, date, event).distinct().withColumn("run", F.row_number().over(w))
    return runs.withColumn("event_key", F.concat_ws("#", F.col(person), F.col("run").cast("string")))


def add_count(df: DataFrame, keys: list[str], out: str = "n") -> DataFrame:
    """Rows per key attached to each row: counted first, then joined, so nothing is gathered. A missing key is a key like any other."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return joins.null_safe(df, counts, keys, "inner")


def person_contacts(df: DataFrame, person: str, date: str, method: str, rank: str) -> DataFrame:
    """Number of contacts, best outcome rank and the methods used, one row per person."""
    return df.groupBy(person).agg(
        F.count(F.lit(1)).alias("contacts"),
        F.min(rank).alias("best_rank"),
        F.max(date).alias("last_date"),
        F.array_join(F.array_sort(F.collect_set(method)), ", ").alias("methods"))


def months_since_previous(df: DataFrame) -> DataFrame:
    return df.withColumn("months_from_previous", dates.complete_months("previous", "scan_date"))
