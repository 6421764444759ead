import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from cohortwise.llm import warc_chunks
from cohortwise.llm.queries import QUERIES
from cohortwise.sources import io

SCHEMA = "page_id long, url string, html string, record string"


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def parse(data):
    """An independent reader of WARC/1.1: (fields, block) of each record."""
    out = []
    while data:
        head, _, rest = data.partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1"
        fields = dict(x.decode().split(": ", 1) for x in lines[1:])
        size = int(fields["Content-Length"])
        assert rest[size:size + 4] == b"\r\n\r\n"
        out.append((fields, rest[:size]))
        data = rest[size + 4:]
    return out


PAGES = [(5, "http://a/\r\nx", "same", "r"), (3, "http://b/", "same", "r"), (9, None, "same", "r"), (1, "http://c/", None, None), (2, "http://d/", "", None),
         (7, "http://e/", "é\r\n\r\nWARC/1.1\r\n" * 50, None), (8, "http://f/", "x" * 1000, None), (None, "http://g/", "x" * 1000, None), (8, "http://f/", "x" * 1000, None),
         (11, "http://h/", "only", None)]


@pytest.fixture
def written(spark):
    path = io.fresh_path(spark, "test-warc")
    warc_chunks.write(spark.createDataFrame(PAGES, SCHEMA).repartition(3), path, chunk_bytes=64)
    return path


def test_rows_of_an_archive_are_a_warc_file(spark, written):
    rows = warc_chunks.read_chunks(spark, written).orderBy("archive", "record", "chunk").collect()
    found = [r for a in sorted({r.archive for r in rows}) for r in parse(b"".join(bytes(r.data) for r in rows if r.archive == a))]
    assert len(found) == len(PAGES)
    for fields, block in found:
        whole = {(str(p) if p is not None else None): h or "" for p, _, h, _ in PAGES}[fields.get("Page-ID")]
        assert fields["WARC-Payload-Digest"] == "sha1:" + sha(whole) and int(fields["Payload-Length"]) == len(whole.encode())
        assert block.decode() == (whole if fields["WARC-Type"] == "response" else "")


def test_chunks_are_bounded_and_carry_running_digests(spark, written):
    rows = warc_chunks.read_chunks(spark, written).collect()
    assert max(len(r.data) - r.payload_start for r in rows) <= 64 + 4
    long_ = sorted((r for r in rows if r.record_id == warc_chunks.record_id(7)), key=lambda r: r.chunk)
    assert len(long_) > 10 and [r.chunk for r in long_] == list(range(len(long_))) and [r.last for r in long_].count(True) == 1
    running = hashlib.sha1()
    for r in long_:
        running.update(bytes(r.data)[r.payload_start:len(r.data) - 4 if r.last else None])
        assert bytes(r.digest) == running.digest()


def test_records_read_back(spark, written):
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, r.intact) for r in warc_chunks.records(spark, written).collect()}
    want = set()
    for p, _, h, _ in PAGES:
        first = {"same": 3, "x" * 1000: 8, "": 1}.get(h or "", p)
        want.add((p, "response" if p == first else "revisit", None if p == first else first, len((h or "").encode()), sha(h), True))
    assert got == want


def test_damage_is_seen(spark, written):
    broken = io.fresh_path(spark, "test-warc")
    rows = warc_chunks.read_chunks(spark, written)
    hit = (F.col("record_id") == warc_chunks.record_id(7)) & (F.col("chunk") == 3)
    rows.withColumn("data", F.when(hit, F.reverse(F.col("data").cast("string")).cast("binary")).otherwise(F.col("data"))).write.parquet(broken)
    assert {r.page_id: r.intact for r in warc_chunks.records(spark, broken).collect()}[7] is False


def test_small_payloads_are_all_responses(spark):
    path = io.fresh_path(spark, "test-warc")
    warc_chunks.write(spark.createDataFrame(PAGES, SCHEMA), path, least_revisit=100)
    kinds = {(r.page_id, r.record_type) for r in warc_chunks.records(spark, path).collect()}
    assert {(5, "response"), (9, "response"), (2, "response"), (None, "revisit")} <= kinds


def test_empty_table(spark):
    assert warc_chunks.written_records(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_brute_force(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet").collect()
    first = {}
    for p in sorted(pages, key=lambda p: p.page_id):
        first.setdefault(p.html, p.page_id)
    want = {(p.page_id, len(p.html.encode()), sha(p.html), "response" if first[p.html] == p.page_id else "revisit", None if first[p.html] == p.page_id else first[p.html]) for p in pages}
    assert {tuple(r) for r in QUERIES["op3_warc_chunks"](spark, small).collect()} == want
