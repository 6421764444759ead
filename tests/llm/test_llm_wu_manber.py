import hashlib
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortwise.llm import wu_manber
from cohortwise.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        size = min(10, len(w))
        for i in range(len(w) - size + 1) if w else ():
            windows[tuple(w[i:i + size])].add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if (got := windows.get(tuple(w[i:i + size]))) is not None:
                    hit.update(range(i, i + size))
                    found |= got
        names = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=3, max_size=3), min_size=1, max_size=6), st.lists(st.integers(0, 3), max_size=40))
def test_search_finds_every_occurrence(patterns, text):
    strings = {tuple(p): [i] for i, p in enumerate(patterns)}
    got = list(wu_manber.WuManber(3, strings, 3).search(text))
    assert got == [(i, strings[tuple(text[i - 2:i + 1])]) for i in range(2, len(text)) if tuple(text[i - 2:i + 1]) in strings]


def test_shifts_skip_words():
    automaton = wu_manber.WuManber(10, {tuple(range(1, 11)): [0]}, 10)

    class Counted(list):
        reads = 0

        def __getitem__(self, i):
            Counted.reads += isinstance(i, int)
            return super().__getitem__(i)
    assert list(automaton.search(Counted([0] * 9000))) == []
    assert Counted.reads <= 2 * 9000 / 9 + 2


ITEM = "one two three four five six seven eight nine ten eleven twelve"
ITEMS = [(1, ITEM), (2, ITEM + " thirteen"), (2, ITEM), (3, "Short Item"), (4, None), (5, "..."), (None, "no id here"), (11, "ONE"), (12, "x1 é漢 y")]
DOCS = [(1, ITEM), (2, None), (3, ""), (4, "..."), (5, "a short-ITEM b"), (6, "zero " + ITEM.replace(" ", ", ") + "!"), (7, "two three four five six seven eight nine ten eleven"),
        (8, "no id here"), (None, "two"), (9, "x1_é漢 Y"), (10, ("filler " * 30 + ITEM + " ") * 3000), (10, "one"), (10, "one"), (13, "nothing to see")]


@pytest.mark.parametrize("table_bytes", [wu_manber.TABLE_BYTES, 60])
def test_edges(spark, frame, table_bytes, monkeypatch):
    items = spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, lang string")
    monkeypatch.setattr(wu_manber, "TABLE_BYTES", table_bytes)
    monkeypatch.setattr(wu_manber.search, "__defaults__", (*wu_manber.search.__defaults__[:4], table_bytes, "found"))
    got = wu_manber.report(frame(DOCS).withColumnRenamed("source", "found"), items).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(DOCS, ITEMS)
    clean = wu_manber.clean(frame(DOCS), items)
    assert clean.columns == frame(DOCS).columns
    assert sorted([(r.doc_id, r.text) for r in clean.collect()], key=str) == sorted([(2, None), (3, ""), (4, "..."), (13, "nothing to see"), (None, "two")], key=str)


def test_empty_tables(spark, frame):
    none = spark.createDataFrame([], "item_id long, text string")
    got = wu_manber.report(frame(DOCS), none).collect()
    assert len(got) == len(DOCS) and not any(r.contaminated for r in got)
    assert wu_manber.report(frame([]), none).collect() == []


def test_query_equals_brute_force(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = QUERIES["op9_wu_manber"](spark, small).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, items)
