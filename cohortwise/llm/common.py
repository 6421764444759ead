"""Shared pieces of the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.sources import io

LEARN_FOLDS = 5


def stage(df: DataFrame, name: str, **options) -> DataFrame:
    """Write a frame to the shared folder and read it back; lost executors re-read the files."""
    path = io.fresh_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most rows and bytes of a batch that goes to a worker, and rows of one that comes back, where batches are kept small.
BATCH_ROWS, BATCH_BYTES, ROWS_BACK = 512, 4 << 20, 1 << 14


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> Iterator[None]:
    """Batches from files and to Arrow tasks of at most so many rows and about BATCH_BYTES bytes, or less where the session says so.

    An executor holds whole batches, at twice their size while they are filled; at Spark's own sizes those of long rows grow with the input of a task.
    """
    most = {"spark.sql.parquet.columnarReaderBatchSize": rows, "spark.sql.execution.arrow.maxRecordsPerBatch": rows,
            "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES}
    before = {n: spark.conf.get(n) for n in most}
    for n, size in most.items():
        own = int(before[n].rstrip("b"))
        spark.conf.set(n, str(min(own, size) if own > 0 else size))
    try:
        yield
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)


def in_parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of ROWS_BACK rows, so that an executor never holds all of a large one."""
    for at in range(0, batch.num_rows, ROWS_BACK):
        yield batch.slice(at, ROWS_BACK)


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of a text column."""
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    elif pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    return column.to_pylist()


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


class _Table(dict):
    """A table that answers an unknown unit with an empty buffer, to be filled once the unit's value is known."""

    def __init__(self):
        super().__init__()
        self.open: list[str] = []

    def __missing__(self, unit: str) -> bytearray:
        buffer = self[unit] = bytearray()
        self.open.append(unit)
        return buffer


class Remembered:
    """Values of text units, each computed once as long as it is remembered.

    About `most` units of at most `longest` characters are held; when there are more, the older half is forgotten. Frequent
    units come back at once, and most of the others would not have been met again.
    """

    def __init__(self, compute: Callable[[list[str]], Iterable[bytes]], most: int, longest: int = 48):
        self.compute, self.most, self.longest = compute, most, longest
        self.known = _Table()

    def __call__(self, rows: Iterable[list[str]]) -> list[list[bytes | bytearray]]:
        """The values of all units of some rows. Each unit is looked up once; new ones are computed together at the end."""
        known = self.known
        get = known.__getitem__
        out = [list(map(get, units)) for units in rows]
        new, known.open = known.open, []
        for unit, value in zip(new, self.compute(new)):
            known[unit].extend(value)  # for the rows above
            known[unit] = value
            if len(unit) > self.longest:
                del known[unit]
        if len(known) > self.most:
            for unit in list(islice(known, len(known) - self.most // 2)):
                del known[unit]
        return out


def held_out(doc_id: str = "doc_id"):
    """Rows that no model learns from: crc32 of the id as text leaves no remainder by 5. A missing id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % LEARN_FOLDS == 0, F.lit(False))
