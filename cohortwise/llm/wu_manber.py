"""Benchmark decontamination by Wu-Manber search over words.

Symbols are words, blocks are pairs of words. All test strings of one automaton have the same length m. For the
block under the window's end, the shift table says how far the window may move without passing over an occurrence;
where the shift is 0, the bucket of that suffix block, and in it the list of the same prefix block, holds the test
strings that are then compared with the text directly.

Defined results: a missing or wordless text has no words, no hits and the digest of the empty string. An item without
words is no test string. An item without an id marks words but is not listed. Items that repeat, or share windows, are
each listed once. With an empty benchmark nothing is hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.llm.common import utf8

WINDOW = 10
#: Text bytes of benchmark items held in one task's tables; a larger benchmark is searched in several passes of one job.
TABLE_BYTES = 8 << 20

_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` after lower-casing A-Z, as UTF-8."""
    return text.translate(_FOLD).split() if text else []


class WuManber:
    """Test strings of m words each, and the entries they stand for."""

    def __init__(self, m: int, strings: dict[tuple[int, ...], list[int]], symbols: int):
        self.m, self.base, self.width = m, symbols + 1, min(2, m)
        self.furthest = m - self.width + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, dict[int, list[tuple[list[int], list[int]]]]] = {}
        for string, entries in strings.items():
            for end in range(self.width - 1, m):
                block = self._block(string, end)
                self.shift[block] = min(self.shift.get(block, self.furthest), m - 1 - end)
            self.buckets.setdefault(self._block(string, m - 1), {}).setdefault(
                self._block(string, self.width - 1), []).append((list(string), entries))

    def _block(self, ids, end: int) -> int:
        return ids[end] if self.width == 1 else ids[end - 1] * self.base + ids[end]

    def search(self, ids: list[int]) -> Iterator[tuple[int, list[int]]]:
        """Ends of occurrences, ascending, with the entries of each; 0 is a word of no test string."""
        m, furthest, shift, base, pairs = self.m, self.furthest, self.shift, self.base, self.width == 2
        at, n = m - 1, len(ids)
        while at < n:
            block = ids[at - 1] * base + ids[at] if pairs else ids[at]
            step = shift.get(block, furthest)
            if step:
                at += step
                continue
            start = at - m + 1
            for string, entries in self.buckets[block].get(self._block(ids, start + self.width - 1), ()):
                if ids[start:at + 1] == string:
                    yield at, entries
            at += 1


class Benchmark:
    """Automata of all windows of some items, one for each string length."""

    def __init__(self, items: Iterable[tuple[str | None, bytes]], window: int = WINDOW):
        self.ids, self.names = {}, []
        by_length: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for name, text in items:
            words = [self.ids.setdefault(w, len(self.ids) + 1) for w in words_of(text)]
            if not words:
                continue
            self.names.append(name)
            size = min(window, len(words))
            strings = by_length.setdefault(size, {})
            for at in range(len(words) - size + 1):
                entries = strings.setdefault(tuple(words[at:at + size]), [])
                if not entries or entries[-1] != len(self.names) - 1:
                    entries.append(len(self.names) - 1)
        self.automata = [WuManber(m, strings, len(self.ids)) for m, strings in sorted(by_length.items())]

    def mark(self, words: list[bytes], hit: bytearray | None, found: set[str]) -> bytearray | None:
        """Flags of the words in any occurrence, None if there is none; names of the items go to found."""
        known = self.ids.get
        ids = [known(w, 0) for w in words]
        for automaton in self.automata:
            for end, entries in automaton.search(ids):
                if hit is None:
                    hit = bytearray(len(words))
                hit[end - automaton.m + 1:end + 1] = b"\x01" * automaton.m
                found.update(n for e in entries if (n := self.names[e]) is not None)
        return hit


def _passes(items: DataFrame, item_id: str, text: str, table_bytes: int) -> list[list[tuple[str | None, bytes]]]:
    items = items.select(F.col(item_id).cast("string").alias("name"), F.col(text).cast("binary").alias("text")).where("text IS NOT NULL")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // table_bytes))
    if parts == 1:
        return [[tuple(r) for r in items.collect()]]
    part = F.pmod(F.xxhash64("name", "text"), F.lit(parts))
    return [[tuple(r) for r in items.where(part == k).collect()] for k in range(parts)]


def search(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
           window: int = WINDOW, table_bytes: int = TABLE_BYTES, into: str = "found") -> DataFrame:
    """All columns of docs and, in a struct column, n_words, n_hit and the names of the items that occur.

    Rows keep their place: nothing is shuffled. Items are searched in passes of about table_bytes of item text, each with
    its own tables; a later pass adds to the flags of the earlier ones, so no occurrence is lost.
    """
    passes = _passes(items, item_id, item_text, table_bytes)
    state = "_wm_state"
    kind = T.StructType([T.StructField("hit", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType()))])
    result = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType()))])
    for k, part in enumerate(passes):
        last = k == len(passes) - 1
        schema = T.StructType([f for f in docs.schema if f.name != state] + [T.StructField(into if last else state, result if last else kind)])
        docs = docs.mapInArrow(_pass(part, window, text, state, into, k == 0, last), schema)
    return docs


def _pass(part, window: int, text: str, state: str, into: str, first: bool, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench = Benchmark(part, window)
        for b in batches:
            before = [None] * b.num_rows if first else b.column(state).to_pylist()
            rows = []
            for raw, old in zip(utf8(b.column(text)), before):
                words = words_of(raw)
                found = set(old["items"]) if old else set()
                hit = bench.mark(words, bytearray(old["hit"]) if old and old["hit"] else None, found)
                names = sorted(found)
                rows.append({"n_words": len(words), "n_hit": sum(hit) if hit else 0, "items": names} if last
                            else {"hit": bytes(hit) if hit else None, "items": names})
            kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string()))] if last
                             else [("hit", pa.binary()), ("items", pa.list_(pa.string()))])
            kept = b if first else b.drop_columns([state])
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(rows, type=kind)], names=[*kept.schema.names, into if last else state])
    return run


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each document."""
    found = search(docs.select("doc_id", "text"), items)
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"),
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no benchmark window occurs, with their own columns."""
    into = "_wm_found"
    return search(docs, items, into=into).where(f"{into}.n_hit = 0").drop(into)


def digest(names: Iterable[str]) -> str:
    return hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
