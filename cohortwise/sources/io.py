"""Readers and writers: warehouse tables, snapshots, submitted files, published tables."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Collection, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.functions import clean


def read_warehouse(spark: SparkSession, url: str, table: str, partition_column: str, lower: int, upper: int,
                   partitions: int, **options) -> DataFrame:
    """Lazy scan of a database table over JDBC, split by a numeric column.

    Filters and column choices on the result are pushed into the database query.
    """
    return (spark.read.format("jdbc").option("url", url).option("dbtable", table)
            .option("partitionColumn", partition_column).option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", partitions).options(**options).load())


def text_schema(columns: Sequence[str], typed: Mapping[str, T.DataType] | None = None) -> T.StructType:
    """Everything arrives as text unless said otherwise."""
    typed = typed or {}
    return T.StructType([T.StructField(c, typed.get(c, T.StringType())) for c in columns])


def read_tables(spark: SparkSession, base: str, names: Sequence[str]) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{base}/{n}.parquet") for n in names}


def save_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a stage's table and read it back, so that later stages start from the files."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_bucketed(df: DataFrame, path: str, key: str, buckets: int | None = None, placed: bool = False) -> DataFrame:
    """Write a table in buckets of a key, as many as shuffle partitions if not given, and read it back.

    Tables of one number of buckets join and group by that key without a shuffle. A bucket is one file, written by one
    task: for tables whose rows per key are bounded, such as current records.

    ``placed`` says that the frame was last grouped, ranked or joined by the key itself: its rows lie together already and
    are written where they are, without being moved again.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _table_name(path)
    rows = df if placed else df.repartition(buckets, key)
    rows.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


def add_to_buckets(df: DataFrame, table: str, key: str) -> DataFrame:
    """Add rows to a table that save_bucketed wrote, in its buckets."""
    spark = df.sparkSession
    buckets = int(spark.sql(f"DESCRIBE FORMATTED {table}").filter("col_name = 'Num Buckets'").first().data_type)
    df.repartition(buckets, key).write.format("parquet").mode("append").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def _table_name(path: str) -> str:
    return "staged_" + re.sub(r"\W", "_", path.rstrip("/").rsplit("/", 1)[-1])


def save_by_month(df: DataFrame, path: str, received: str = "ReceivedDate") -> DataFrame:
    """A snapshot with one folder per month of receipt (column received_month, yyyy-MM)."""
    return save_snapshot(df.withColumn("received_month", F.date_format(received, "yyyy-MM")), path, ["received_month"])


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType) -> DataFrame:
    return spark.read.csv(paths, schema=schema, header=True)


def read_submissions(spark: SparkSession, paths: Sequence[str], schema: T.StructType, required: str) -> DataFrame:
    """Many files in one scan, each row tagged with its file; rows without an id go."""
    return (spark.read.csv(list(paths), schema=schema, header=True)
            .select("*", F.col("_metadata.file_path").alias("source_file"))
            .dropna(subset=[required]))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """All files below a folder: path, length, modified. Only the file system's listing is read, no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def read_checked(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, broken: str = "broken_row") -> DataFrame:
    """Files with all their rows: what does not fit the schema is missing, and the row as it stands is in the column for broken rows."""
    wide = T.StructType([*schema, T.StructField(broken, T.StringType())])
    return spark.read.csv(paths, schema=wide, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=broken)


def parse_path(df: DataFrame, path: str) -> DataFrame:
    """Folder, project code, month and year out of {folder}/{code}_{month}_{year}.xlsx."""
    pattern = r"([^/]+)/([^/_]+)_([A-Za-z]+)_(\d{4})\.xlsx$"
    part = lambda i: F.nullif(F.regexp_extract(path, pattern, i), F.lit(""))
    return (df.withColumns({"ccg_name": part(1), "ccg_code": part(2), "month_name": part(3), "year": part(4)})
            .withColumn("file_date", F.try_to_timestamp(
                F.concat_ws(" ", F.lit("1"), F.substring("month_name", 1, 3), "year"), F.lit("d MMM yyyy")).cast("date")))


def file_flags(df: DataFrame, path: str, codes: Sequence[str] | DataFrame, first: str, last: str) -> DataFrame:
    """Acceptance checks of submitted files, whether all hold, and the first reason against."""
    if isinstance(codes, DataFrame):
        known = codes.select(F.col(codes.columns[0]).alias("ccg_code")).distinct().withColumn("_known", F.lit(True))
        df = df.join(known, "ccg_code", "left").withColumn("dq_code", F.coalesce("_known", F.lit(False))).drop("_known")
    else:
        df = df.withColumn("dq_code", clean.one_of("ccg_code", codes))
    p = F.col(path)
    df = df.withColumns({
        "dq_month": F.coalesce(F.col("file_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")), F.lit(False)),
        "dq_working": ~p.isin("Working.xlsx", "ProjCode_Month_Year.xlsx"),
        "dq_backup": ~p.contains("~"),
        "dq_archived": ~p.rlike("archive|Archive"),
        "dq_filename": p.rlike(r".*/.*_.*_\d{4}\.xlsx"),
    })
    ok = F.col("dq_code") & F.col("dq_month") & F.col("dq_working") & F.col("dq_backup") & F.col("dq_archived") & F.col("dq_filename")
    return df.withColumn("dq_flag", ok).withColumn(
        "dq_message", F.when(~F.col("dq_working"), "Excluded").when(~F.col("dq_backup"), "Excluded - backup file")
        .when(~F.col("dq_archived"), "Archived").when(~F.col("dq_filename"), "DQ - folder/file not in expected format")
        .when(~F.col("dq_code"), "DQ - CCG code not in accepted list")
        .when(~F.col("dq_month"), "DQ - month is not in reporting period").otherwise("Unknown"))


def accepted_and_rejected(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter("dq_flag"), df.filter("NOT dq_flag")


def row_flags(df: DataFrame, metric_ids: Sequence[str], broken: str | None = None) -> DataFrame:
    """Row checks: known metric, numerator missing, numerator zero, and row not broken where that column is named; any problem sets dq_problem."""
    df = df.withColumns({"dq_metric_id": clean.one_of("metric_id", metric_ids), "dq_numerator_na": F.col("numerator").isNull(),
                         "dq_numerator_zero": F.coalesce(F.col("numerator") == 0, F.lit(False))})
    problem = ~F.col("dq_metric_id") | F.col("dq_numerator_na") | F.col("dq_numerator_zero")
    if broken is not None:
        df = df.withColumn("dq_broken", F.col(broken).isNotNull())
        problem = problem | F.col("dq_broken")
    return df.withColumn("dq_problem", problem)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_datasheets(df: DataFrame, path: str) -> None:
    """One directory per project and month from a single job; each is filled by one task."""
    (df.repartition("project_code", "month").sortWithinPartitions("project_code", "month", "metric_order")
     .write.mode("overwrite").partitionBy("project_code", "month").csv(path, header=True))


def write_bundle(results: Mapping[str, DataFrame], path: str) -> list[str]:
    """Named report tables, one directory each."""
    for name, df in results.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
    return [f"{path}/{n}" for n in results]


def split_long_methods(spark: SparkSession) -> None:
    """Leave steps out of a fused stage whose code the JVM would only interpret.

    HotSpot compiles no method of more than 8000 bytes. Spark fuses a stage into one method of up to 65535; the same steps run
    apart are split into short methods. Many text columns, as in raw records, pass that bound.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


#: Input of a task where the session names no size of its own.
TASK_INPUT = {"spark.sql.files.maxPartitionBytes": "8m", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}


def small_tasks(spark: SparkSession) -> None:
    """Give a task as much input as its records can be sorted in memory.

    Some 15 bytes of a compressed row unfold into a raw record of about 500, and records are ranked whole. At Spark's own sizes a
    task meets several million of them and writes its sort to disk. Sizes that the session names are left.
    """
    for name, size in TASK_INPUT.items():
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, size)


def keep_places(spark: SparkSession) -> None:
    """Let joins by person and something else meet rows where they lie by person, and read buckets in the order they were written."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")


def forget_places(spark: SparkSession) -> None:
    """Spark's own way again, which spreads rows by all keys of a join: for keys of which one alone has few values."""
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "true")


_TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Staged frames are written small, and their shuffle files go as soon as they are written: nothing reads them again."""
    before = {n: spark.conf.get(n) for n in _TIDY}
    for n, v in _TIDY.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def work_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables: the cluster's checkpoint folder.

    Only where the session names none and all its tasks run on this machine, as in tests, a folder of our own is set;
    on a cluster each executor would write to a disk of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="cohortwise-")
        context.setCheckpointDir(named)
    return named


_WRITTEN: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; release() removes what was written there."""
    path = f"{work_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _WRITTEN:
        atexit.register(release, spark)
    _WRITTEN.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Remove the staged tables of this run: by hand once no frame reads them any more, and when the program ends."""
    context = spark.sparkContext
    while _WRITTEN and context._jsc is not None:
        spark.sql(f"DROP TABLE IF EXISTS {_table_name(_WRITTEN[-1])}")
        path = context._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def staged(spark: SparkSession, only: Collection[str] | None = None, keep: Mapping[str, Sequence[str]] | None = None,
           plain: Collection[str] = ()):
    """Stage function for plans.Cohort: write a frame to the shared folder and read it back.

    The written table survives lost executors, ends the lineage, and later steps read
    only the columns they need. A frame that comes with a key is written in buckets of it.
    ``keep`` names, by frame, the columns that are read later; others are neither computed nor written. Frames in ``plain``
    are written where their rows are, also where they come with a key: for those of which few rows are joined by it.
    """
    def stage(df: DataFrame, name: str, key: str | None = None, placed: bool = False, buckets: int | None = None) -> DataFrame:
        if only is not None and name not in only:
            return df
        if keep is not None and name in keep:
            df = df.select(*keep[name])
        path = fresh_path(spark, name)
        with _tidy(spark):
            return save_snapshot(df, path) if key is None or name in plain else save_bucketed(df, path, key, buckets, placed)

    def append(first: DataFrame, more: DataFrame, key: str) -> DataFrame:
        """A frame that was written in buckets of the key, with more rows: these alone are written."""
        files = first.inputFiles()
        if not files:  # nothing was written
            return first.unionByName(more)
        with _tidy(spark):
            return add_to_buckets(more.select(first.columns), _table_name(files[0].rsplit("/", 1)[0]), key)

    stage.append, stage.writes = append, lambda name: only is None or name in only
    return stage
