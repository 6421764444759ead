"""What a task and its executor hold at once does not grow with the input of the task."""

import glob

import pyarrow as pa
import pyarrow.parquet as pq

from cohortwise.llm import collocations, common


def test_batches_to_tasks_are_small_and_the_session_keeps_its_sizes(spark):
    names = ["spark.sql.parquet.columnarReaderBatchSize", "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = [spark.conf.get(n) for n in names]
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches)
    with common.small_batches(spark, 100):
        seen = [r.n for r in spark.range(1000).coalesce(1).mapInArrow(sizes, "n long").collect()]
    assert sum(seen) == 1000 and max(seen) <= 100
    assert [spark.conf.get(n) for n in names] == before


def test_a_large_batch_comes_back_in_parts():
    n = 2 * common.ROWS_BACK + 1
    parts = list(common.in_parts(pa.RecordBatch.from_pydict({"n": list(range(n))})))
    assert [p.num_rows for p in parts] == [common.ROWS_BACK, common.ROWS_BACK, 1]
    assert [v for p in parts for v in p.column("n").to_pylist()] == list(range(n))


def test_stretches_are_written_and_read_a_few_at_once(spark, monkeypatch):
    """Three texts that fill a stretch each, in one task: without a bound they lie in one row group."""
    monkeypatch.setattr(collocations, "STRETCHES", 1)
    text = "a b c d " * (collocations.FLUSH // 4 + 10)
    df = spark.createDataFrame([("en", text)] * 3, "lang string, text string").coalesce(1)
    words = spark.createDataFrame([("en", w) for w in "abcd"], "lang string, phrase string")
    out = collocations._encoded(df, collocations.Bits.of(collocations._hashed(words)), 5)
    files = [pq.ParquetFile(f) for f in glob.glob(out.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0] + "/*.parquet")]
    rows = [f.metadata.row_group(i).num_rows for f in files for i in range(f.num_row_groups)]
    assert len(rows) >= 3 and max(rows) == 1
    ids = [len(r.ids) // r.width for r in out.collect()]
    assert max(ids) < 2 * collocations.FLUSH
