"""Long and wide forms, completion of combinations, calendars, row replication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.operators import joins


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return (df.unpivot(list(ids), list(columns), name, value).filter(F.col(value).isNotNull()))


def to_wide(df: DataFrame, rows: Sequence[str], column: str, values: Sequence, agg: Column,
            fill=None, prefix: str = "") -> DataFrame:
    """Wide table over given values; the values are stated, so no extra job looks them up."""
    wide = df.groupBy(*rows).pivot(column, list(values)).agg(agg)
    cells = [F.col(f"`{v}`") if fill is None else F.coalesce(F.col(f"`{v}`"), F.lit(fill)) for v in values]
    return wide.select(*rows, *[c.alias(f"{prefix}{v}") for c, v in zip(cells, values)])


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; columns that a table lacks are NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def complete(df: DataFrame, outer: Sequence[str], inner: Sequence[str], keep: str, fill=None) -> DataFrame:
    """All of df's ``outer`` combinations with all its ``inner`` ones; a missing key is a key like any other.

    The inner combinations are levels (metrics, not rows): they travel as one array and unfold on each outer combination.
    """
    levels = df.select(F.collect_set(F.struct(*inner))).scalar()
    grid = (df.select(*outer).distinct().withColumn("_v", F.explode(levels))
            .select(*outer, *[F.col(f"_v.{n}").alias(n) for n in inner]))
    out = joins.null_safe(grid, df.select(*outer, *inner, keep), [*outer, *inner], "left")
    return out if fill is None else out.fillna({keep: fill})


def months(start: Column, end: Column) -> Column:
    """Array of first days of months from start to end; runs backwards when end is earlier."""
    step = F.when(end < start, F.expr("interval -1 month")).otherwise(F.expr("interval 1 month"))
    return F.sequence(start, end, step)


def uncount(df: DataFrame, weight: str) -> DataFrame:
    """As many copies of a row as its weight says; none for zero."""
    return (df.filter(F.col(weight) >= 1)
            .withColumn("_i", F.explode(F.sequence(F.lit(1), F.col(weight).cast("int")))).drop("_i", weight))


def select_by_type(df: DataFrame, kind: type[T.DataType], keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema.fields if f.name in keep or isinstance(f.dataType, kind)])


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    return df.fillna(dict(defaults))


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)
