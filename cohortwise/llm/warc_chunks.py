"""WARC records as a table of chunks.

An archive is a table of rows (archive, record, record_id, chunk, last, data, payload_start, digest). The data of an archive's
rows, in the order of record and chunk, are the bytes of a WARC/1.1 file. A payload is cut into chunks of at most `chunk_bytes`;
the first chunk also carries the record's header, the last one the two line ends that close it. Each row's digest is the SHA-1 of
the payload up to and including this row, so that a reader can stop at the first chunk that went wrong, and neither writer nor
reader joins the chunks of a record.

Records with equal payloads: that with the smallest page_id is written whole, the others as revisit records that name
it. Payloads under `least_revisit` bytes are always written whole.

Defined results: a missing payload is an empty one, a missing url has no target line. A missing page_id is written as a record without
an id of its page and is the last choice as a response. Rows that repeat a response's id and payload are responses too. An empty
table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import batch
from cohortwise.sources import io

CHUNK_BYTES = 1 << 18
_END = b"\r\n\r\n"
_CHUNK = pa.schema([("archive", pa.int32()), ("record", pa.int64()), ("record_id", pa.string()), ("chunk", pa.int32()), ("last", pa.bool_()),
                    ("data", pa.binary()), ("payload_start", pa.int32()), ("digest", pa.binary())])
_CHUNK_DDL = "archive int, record long, record_id string, chunk int, last boolean, data binary, payload_start int, digest binary"
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # that of URLs


def base32(sha1_hex):
    """Bare upper-case base32 of a SHA-1 in hex, as a column."""
    def group(i: int):
        digits = F.lpad(F.conv(F.substring(sha1_hex, 5 * i + 1, 5), 16, 32), 4, "0")
        return F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(*[group(i) for i in range(8)])


def record_id(page_id) -> str:
    return f"urn:uuid:{uuid.uuid5(_NAMESPACE, f'page/{page_id}')}"


def _one_line(value: str) -> str:
    return " ".join(value.split())


def header(kind: str, page_id, url: str | None, size: int, digest: str, refers_to, date: str) -> bytes:
    """Header lines up to and including the empty one. Payload-Length is an extension field: the size of a payload that a revisit leaves out."""
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(page_id)}>"), ("WARC-Date", date)]
    if url:
        fields.append(("WARC-Target-URI", _one_line(url)))
    if page_id is not None:
        fields.append(("Page-ID", page_id))
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Payload-Length", size)]
    if kind == "revisit":
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", f"<{record_id(refers_to)}>")]
        if refers_to is not None:
            fields.append(("Refers-To-Page-ID", refers_to))
    fields += [("Content-Type", "text/html; charset=utf-8"), ("Content-Length", 0 if kind == "revisit" else size)]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n").encode()


def chunks(head: bytes, payload: memoryview, chunk_bytes: int) -> Iterator[tuple[bool, bytes, int, bytes]]:
    """(last, data, place of the payload in data, SHA-1 so far) of each chunk of a record."""
    running, size = hashlib.sha1(), len(payload)
    for at in range(0, max(size, 1), chunk_bytes):
        piece = payload[at:at + chunk_bytes]
        running.update(piece)
        last = at + chunk_bytes >= size
        yield last, b"".join((head if at == 0 else b"", piece, _END if last else b"")), len(head) if at == 0 else 0, running.copy().digest()


def decide(pages: DataFrame, payload: str = "html", least_revisit: int = 0) -> DataFrame:
    """page_id, url, payload with its digest, and refers_to (a struct with the response's page_id) where the row is a revisit.

    The smallest id of each payload comes from a narrow aggregate of ids and digests; only payloads that occur more
    than once are joined back.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("sha1", F.sha1(F.col("payload").cast("binary")))
    equal = (rows.where(F.octet_length("payload") >= least_revisit).groupBy("sha1")
             .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("sha1", F.struct("first").alias("response")))
    return rows.join(equal, "sha1", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("response.first")), F.col("response")))


def _writer(chunk_bytes: int, date: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, record = TaskContext.get().partitionId(), 0
        for b in batches:
            payloads = b.column("payload")
            payloads = payloads.cast(pa.large_binary() if pa.types.is_large_string(payloads.type) else pa.binary())
            held, rows = 0, []
            for page_id, url, sha1, refers, payload in zip(b.column("page_id").to_pylist(), b.column("url").to_pylist(), b.column("sha1").to_pylist(),
                                                           b.column("refers_to").to_pylist(), payloads):
                view = memoryview(payload.as_buffer()) if len(payload.as_buffer()) else memoryview(b"")
                digest, revisit = base64.b32encode(bytes.fromhex(sha1)).decode(), refers is not None
                head = header("revisit" if revisit else "response", page_id, url, len(view), digest, refers["first"] if revisit else None, date)
                name = record_id(page_id)
                for number, (last, data, start, sofar) in enumerate(chunks(head, view[:0] if revisit else view, chunk_bytes)):
                    rows.append((archive, record, name, number, last, data, start, sofar))
                    held += len(data)
                    if held >= 16 * chunk_bytes:
                        yield batch(_CHUNK, **dict(zip(_CHUNK.names, zip(*rows))))
                        held, rows = 0, []
                record += 1
            if rows:
                yield batch(_CHUNK, **dict(zip(_CHUNK.names, zip(*rows))))
    return run


def write(pages: DataFrame, path: str, payload: str = "html", least_revisit: int = 0, chunk_bytes: int = CHUNK_BYTES,
          date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record for each row of pages (page_id, url and the payload)."""
    rows = decide(pages, payload, least_revisit).select("page_id", "url", "sha1", "refers_to", "payload")
    rows.mapInArrow(_writer(chunk_bytes, date), _CHUNK_DDL).write.option("compression", "zstd").parquet(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_CHUNK_DDL).parquet(path)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running digests over the chunks of records, one chunk in hand at a time."""
    kind = pa.schema([("archive", pa.int32()), ("record", pa.int64()), ("sha1", pa.string()), ("size", pa.int64()), ("intact", pa.bool_()), ("head", pa.binary())])
    key, running, size, intact, head, expected = None, None, 0, True, b"", 0
    for b in batches:
        for archive, record, chunk, last, data, start, digest in zip(*(b.column(c).to_pylist() for c in ("archive", "record", "chunk", "last", "data", "payload_start", "digest"))):
            if (archive, record) != key:
                key, running, size, intact, head, expected = (archive, record), hashlib.sha1(), 0, True, data[:start], 0
            piece = memoryview(data)[start:len(data) - len(_END) if last else len(data)]
            running.update(piece)
            size += len(piece)
            intact = intact and chunk == expected and running.digest() == digest
            expected += 1
            if last:
                yield batch(kind, archive=[archive], record=[record], sha1=[running.hexdigest()], size=[size], intact=[intact], head=[head])


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record, from the archives: header fields, size and SHA-1 of the stored payload, and whether all digests hold.

    Records of one chunk are read where they lie. Only the chunks of longer records are brought together, and then streamed.
    """
    found = read_chunks(spark, path)
    whole = F.col("last") & (F.col("chunk") == 0)
    end = F.octet_length("data") - len(_END)
    body = F.expr("substring(data, payload_start + 1, length(data) - payload_start - 4)")
    short = found.where(whole).select(
        "archive", "record", F.sha1(body).alias("sha1"), (end - F.col("payload_start")).cast("long").alias("size"),
        (F.unhex(F.sha1(body)) == F.col("digest")).alias("intact"), F.expr("substring(data, 1, payload_start)").alias("head"))
    long_ = (found.where(~whole).repartition("archive", "record").sortWithinPartitions("archive", "record", "chunk")
             .mapInArrow(_verify, "archive int, record long, sha1 string, size long, intact boolean, head binary"))
    text = F.decode("head", "UTF-8")
    field = lambda name: F.nullif(F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))
    return short.union(long_).select(
        "archive", "record", field("WARC-Type").alias("record_type"), field("WARC-Record-ID").alias("record_id"), field("WARC-Target-URI").alias("url"),
        field("Page-ID").cast("long").alias("page_id"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha1:", "").alias("payload_digest"),
        field("Payload-Length").cast("long").alias("payload_bytes"), field("Refers-To-Page-ID").cast("long").alias("refers_to"),
        "size", base32(F.upper("sha1")).alias("stored_digest"), "intact")


def written_records(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each page, by way of the archives.

    Of a response, size and digest are those of the bytes that were read; of a revisit, those of its header.
    """
    spark = pages.sparkSession
    path = io.fresh_path(spark, "warc-chunks")
    write(pages, path)
    response = F.col("record_type") == "response"
    return records(spark, path).select(
        "page_id", F.when(response, F.col("size")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("stored_digest")).otherwise(F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to")
