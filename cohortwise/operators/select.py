"""Which rows count: exclusions, current record per key, snapshots, validity flags."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exclude_listed(df: DataFrame, listed: DataFrame, key: str, keep_missing: bool = False) -> DataFrame:
    """Drop rows whose key is on a list.

    Rows without a key drop too, as in a NOT IN filter on a database; set keep_missing
    for the local form of the same filter. The list joins by Spark's own size check:
    small lists broadcast, long ones shuffle.
    """
    kept = df.join(listed.select(key).dropDuplicates(), key, "left_anti")
    return kept if keep_missing else kept.filter(F.col(key).isNotNull())


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    A row_number filter lets Spark cut every map task down to one row per key before
    the shuffle, so a key that holds a third of the table does not end up in one task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], received: str = "ReceivedDate",
                   sequence: str = "CSURowNumber", home: str | None = None) -> DataFrame:
    """Newest submission per key: latest receipt, then highest row number.

    What is still tied is settled by the other columns in order, so results repeat. ``home`` names the one of several keys by
    which later steps need the rows: they are moved by it at once, and not by all keys first.
    """
    df = df if home is None else df.repartition(home)
    settled = {*keys, received, sequence}
    tie = [F.col(f"`{c}`").asc_nulls_first() for c in sorted(df.columns) if c not in settled]
    return top_per_key(df, keys, [F.col(received).desc_nulls_last(), F.col(sequence).desc_nulls_last(), *tie])


def ranked_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All rows that tie for first place in their group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rk", F.rank().over(w)).filter("_rk = 1").drop("_rk")


def newest_snapshot(df: DataFrame, column: str = "DatasetId") -> DataFrame:
    """Rows of the newest snapshot; the maximum is a scalar subquery, not a join."""
    return df.filter(F.col(column) == df.select(F.max(column)).scalar())


def latest_submission(df: DataFrame, group: str, received: str = "ReceivedDate") -> DataFrame:
    """Rows at their group's last receipt, aggregated first so that big groups stay spread out."""
    last = df.groupBy(group).agg(F.max(received).alias("_last"))
    return (df.join(last, df[group].eqNullSafe(last[group]) & (df[received] == last["_last"]), "left_semi"))


def recent_headers(df: DataFrame, since: str, columns: Sequence[str], received: str = "ReceivedDate") -> DataFrame:
    return df.filter(F.col(received) >= F.lit(since).cast("date")).select(*columns).distinct()


def recent_from_months(snapshot: DataFrame, since: str, columns: Sequence[str], received: str = "ReceivedDate") -> DataFrame:
    """The same from a snapshot by month (see io.save_by_month): only the folders of the months asked for are read."""
    return recent_headers(snapshot.filter(F.col("received_month") >= since[:7]), since, columns, received)


def person_validity(df: DataFrame, key: str = "ParticipantID", shortest: int = 60,
                    out: str = "person_validity") -> DataFrame:
    return df.withColumn(out, F.when(F.length(key) < shortest, "Invalid").otherwise("Valid"))


def transaction_validity(df: DataFrame, latest_only_org: str | None, listed: Sequence[int],
                         org: str = "org_code", transaction: str = "TransactionId",
                         out: str = "transaction_validity") -> DataFrame:
    """For one submitter only its highest transaction counts; listed transactions never do."""
    bad = F.col(transaction).isin(list(listed)) if listed else F.lit(False)
    if latest_only_org is not None:
        newest = df.filter(F.col(org) == latest_only_org).select(F.max(transaction)).scalar()
        bad = bad | ((F.col(org) == latest_only_org) & (F.col(transaction) < newest))
    return df.withColumn(out, F.when(bad, "Invalid").otherwise("Valid"))


def submitter_transactions(df: DataFrame, org: str, newer_than: int,
                           transaction: str = "TransactionId", file: str = "SubmittedZipFile") -> DataFrame:
    return (df.filter((F.substring(file, 1, 5) == org) & (F.col(transaction) > newer_than))
            .select(transaction).distinct().orderBy(F.desc(transaction)))


def members(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    return df.join(others.select(key).dropDuplicates(), key, "left_semi")


def non_members(df: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the other table; rows without a key are kept."""
    return df.join(others.select(key).dropDuplicates(), key, "left_anti")


def drop_repeated_diagnoses(df: DataFrame, person: str, date: str, source: str, mark: Column,
                            key: str, within_days: int = 100, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Drop a diagnosis that repeats the one before it from another source.

    The order is person, date, source, fingerprint, key. Within one such group only the
    first row can follow a different source, so the groups are collapsed before the
    window: the window sees distinct combinations, however many rows a person has. ``stage`` writes the keys of the repeats, so
    that Spark knows their size before it plans the join: where they are few, the rows stay in place.
    """
    marked = df.withColumn("_mark", mark)
    groups = marked.groupBy(person, date, source, "_mark").agg(F.min(key).alias("_first"))
    w = Window.partitionBy(person).orderBy(date, source, "_mark")
    before = lambda c: F.lag(c).over(w)
    repeated = (groups
                .withColumn("_same", (before("_mark") == F.col("_mark"))
                            & (before(source) != F.col(source))
                            & (F.datediff(date, before(date)) < within_days))
                .filter("_same").select(F.col("_first").alias(key)))
    return df.join(stage(repeated), key, "left_anti")
