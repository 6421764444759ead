"""Token ids on disk: one concatenated id array per segment, with Elias-Fano coded document boundaries.

Documents are dealt by ranges of doc_id and sorted, encoded, and gathered into segments of about SEGMENT ids. A segment
is one row of a Parquet table, so that Spark's commit protocol decides which attempt of a task counts:

    part, segment   place of the segment: part files follow doc_id, segments count up inside a part
    offset          ids in earlier segments of the part
    doc_ids         ids of its documents, ascending
    width, ids      bytes per token id (2 or 4), and all token ids, little-endian
    low_bits, low, high, samples
                    the documents' end offsets inside the segment as an Elias-Fano sequence

Elias-Fano keeps low_bits bits of each end in `low` and the rest in unary in `high`, about 2 + log2(ids per document)
bits a document; `samples` holds the place of each 64th set bit, so that select() reads at most a few words. Offsets of a
part in the whole corpus are sums over the parts before it, one row for each part file.

Defined results: a missing text is an empty one and consists of the end id alone. Missing ids come first. Rows with the same id
are ordered by text. An empty table gives an empty table.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortwise.llm.common import Remembered, batch
from cohortwise.sources import io

SEGMENT = 1 << 18
#: Distinct text units whose ids one Python worker remembers.
REMEMBERED = 1 << 20
#: New words that go to the library as one string.
JOINED = 256
SAMPLE = 64


class EliasFano:
    """A non-decreasing sequence of n integers not above `universe`."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.samples = np.frombuffer(samples, "<u4")

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values, n = np.asarray(values, np.int64), len(values)
        low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
        lows = (values[:, None] >> np.arange(low_bits)) & 1
        places = (values >> low_bits) + np.arange(n)
        bits = np.zeros((universe >> low_bits) + n + 1, np.uint8)
        bits[places] = 1
        return cls(n, low_bits, np.packbits(lows.astype(np.uint8).ravel(), bitorder="little").tobytes(),
                   np.packbits(bits, bitorder="little").tobytes(), places[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        window = int.from_bytes(self.low[first >> 3:(first + self.low_bits + 7) >> 3].tobytes(), "little")
        return (window >> (first & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value, from the sample before it and the set bits that follow."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        at, byte = place >> 3, int(self.high[place >> 3]) >> (place & 7) << (place & 7)
        while (count := byte.bit_count()) <= left:
            left -= count
            at += 1
            byte = int(self.high[at])
        for _ in range(left):
            byte &= byte - 1
        place = at * 8 + (byte & -byte).bit_length() - 1
        return (place - i) << self.low_bits | self._low(i)

    def values(self) -> np.ndarray:
        places = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        highs = (places - np.arange(self.n)) << self.low_bits
        bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
        return highs + (bits.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)


_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"


class UnitEncoder:
    """Ids of whole texts by a byte-level BPE file of the tokenizers library.

    The file's split pattern ends a token where white space begins, and where a run of letters ends, so a text's ids are those of its units in
    a row: white space and letters up to the next other character, or white space and all that follows up to the next white space.
    Units repeat; the library encodes each once. New units of one space or line end and letters go to it as one string, whose ids are
    dealt to the units by the bytes that each token stands for.
    Four control characters count as white space for Python only; texts that hold one are encoded in one piece. So are, where `added`, texts
    that hold an added token of the file: its id is then that of the token, as the library gives it. Else it is text like any other.
    """

    UNIT = re.compile(rf"\s*[{_LETTERS}]++(?=[\s!-@\[-`{{-~]|\Z)|\s*\S+|\s+")
    WORD = re.compile(f" [{_LETTERS}]+")
    ODD = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str, added: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core; the library's own threads keep memory each
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not added
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added else []
        self.whole = [*self.ODD, *names]
        vocabulary = self.tokenizer.get_vocab()
        self.width = 2 if max(vocabulary.values()) < 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)  # a character of a byte-level token is a byte
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)
        self.remembered = Remembered(self._learn, REMEMBERED)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _learn(self, units: list[str]) -> list[bytes]:
        words = list(filter(self.WORD.fullmatch, units))
        found: dict[str, bytes] = {}
        parts = [words[at:at + JOINED] for at in range(0, len(words), JOINED)]
        for part, encoded in zip(parts, self.tokenizer.encode_batch_fast(["".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(encoded.ids, self.kind)
            ends = np.cumsum([len(u.encode()) for u in part])
            upto = np.cumsum(self.bytes_of[ids])
            cuts = np.searchsorted(upto, ends) + 1
            if (upto[cuts - 1] != ends).any():
                raise ValueError("a token crosses words: this tokenizer file splits text in another way")
            packed, cuts = ids.tobytes(), (cuts * self.width).tolist()
            found.update(zip(part, [packed[a:z] for a, z in zip([0, *cuts], cuts)]))
        others = [u for u in units if u not in found]
        for u, encoded in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False)):
            found[u] = np.array(encoded.ids, self.kind).tobytes()
        return list(map(found.__getitem__, units))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text."""
        whole = [any(w in t for w in self.whole) for t in texts]
        values = iter(self.remembered(self.UNIT.findall(t) for t, w in zip(texts, whole) if not w))
        return [self._ids(t).tobytes() if w else b"".join(next(values)) for t, w in zip(texts, whole)]


_SEGMENT = pa.schema([("part", pa.int32()), ("segment", pa.int32()), ("offset", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                      ("width", pa.int32()), ("ids", pa.binary()), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary())])
_SEGMENT_DDL = ("part int, segment int, offset long, n_ids long, doc_ids array<long>, width int, ids binary, "
                "low_bits int, low binary, high binary, samples binary")
_ENCODERS: dict[tuple[str, bool], UnitEncoder] = {}
#: Text bytes encoded at a time.
SLICE = 1 << 20


def _writer(tokenizer: str, end_id: int, segment: int, added: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _ENCODERS.get((tokenizer, added)) or _ENCODERS.setdefault((tokenizer, added), UnitEncoder(tokenizer, added))
        end = np.array([end_id], encoder.kind).tobytes()
        part, number, offset = TaskContext.get().partitionId(), 0, 0
        ids, ends, arrays, total = [], [], [], 0

        def close() -> pa.RecordBatch:
            ef = EliasFano.of(np.array(ends), total)
            return batch(_SEGMENT, part=[part], segment=[number], offset=[offset], n_ids=[total], doc_ids=[ids], width=[encoder.width],
                         ids=[b"".join(arrays)], low_bits=[ef.low_bits], low=[ef.low.tobytes()], high=[ef.high.tobytes()], samples=[ef.samples.tobytes()])

        for b in batches:
            names, texts = b.column("doc_id").to_pylist(), b.column("text")
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)) // SLICE
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                for name, packed in zip(names[lo:hi], encoder.encode([t or "" for t in texts[lo:hi].to_pylist()])):
                    arrays += (packed, end)
                    total += len(packed) // encoder.width + 1
                    ids.append(name)
                    ends.append(total)
                    if total >= segment:
                        yield close()
                        number, offset = number + 1, offset + total
                        ids, ends, arrays, total = [], [], [], 0
        if ids:
            yield close()
    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, segment: int = SEGMENT, added: bool = False) -> None:
    """Write the token ids of documents (doc_id, text) in ascending doc_id order, an end id after each."""
    dealt = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    dealt.mapInArrow(_writer(tokenizer, end_id, segment, added), _SEGMENT_DDL).write.parquet(path)


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with `start`, the ids of the whole corpus before each."""
    found = spark.read.schema(_SEGMENT_DDL).parquet(path)
    parts = found.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row for each part file
    return found.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("offset"))


_ROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in b.to_pylist():
            ends = EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["samples"]).values()
            starts = np.concatenate([[0], ends[:-1]])
            ids = memoryview(np.frombuffer(row["ids"], f"<u{row['width']}").astype("<u4")).cast("B")
            yield batch(_ROW, doc_id=row["doc_ids"], start=starts + row["start"], n_tokens=ends - starts,
                        ids_crc32=[zlib.crc32(ids[4 * a:4 * z]) for a, z in zip(starts.tolist(), ends.tolist())])


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    return segments(spark, path).drop("part", "segment", "offset", "before").mapInArrow(
        _digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int32()))])
    for b in batches:
        for row in b.to_pylist():
            ends = EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["samples"]).values()
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], f"<u{row['width']}").astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), pa.array(starts + row["start"]), lists], schema=kind)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and the token ids of each document, its end id included."""
    return segments(spark, path).drop("part", "segment", "offset", "before").mapInArrow(_read, "doc_id long, start long, ids array<int>")


def written_digests(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    spark = docs.sparkSession
    path = io.fresh_path(spark, "token-shards")
    write(docs, path, tokenizer, end_id, added=True)  # the ids of the library as loaded
    return digests(spark, path)
