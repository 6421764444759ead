import random
from collections import Counter
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortwise.llm import simhash_tiles as sim
from cohortwise.llm.queries import QUERIES


def slow_print(text, size=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups(prints, radius=2):
    """Root (smallest index) of each fingerprint's component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "Two Words", "ONE two Three", "a b c d", "É é ÀB x\x0by", "w " * 70_000, "x" * 100_000, "a a a a a"])
def test_fingerprint(text):
    assert sim.fingerprint(text.encode() if text is not None else None) == slow_print(text)


def family(seed, n, flips=3, base=None):
    rng = random.Random(seed)
    out = [base if base is not None else rng.getrandbits(64)]
    while len(out) < n:
        x = rng.choice(out)
        for _ in range(rng.randint(1, flips)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


@pytest.mark.parametrize("tile", [3, 16, 1024])
def test_tiles_keep_components(tile):
    prints = sorted({*family(1, 150), *family(2, 60), *(random.Random(3).getrandbits(64) for _ in range(50)), 0})
    a, b = sim.tile_links(np.array(prints, np.uint64), tile=tile)
    assert len(a) < len(prints)
    place = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for x, y in zip(a.tolist(), b.tolist()):
        i, j = find(place[x]), find(place[y])
        root[max(i, j)] = min(i, j)
    assert [find(i) for i in range(len(prints))] == groups(prints)


def test_short_runs_share_tiles(monkeypatch):
    """Many short runs and some long ones: links stay inside their runs, and every pair of a run comes through tiles."""
    rng, keys, prints = random.Random(4), [], []
    for k in range(400):
        for p in sorted(set(family(k, rng.choice([1, 2, 3, 9, 70])))):
            keys.append(k)
            prints.append(p)
    tiled, of = [], sim.tile_links

    def counted(p, radius, tile, run=None):
        tiled.append(len(p))
        return of(p, radius, tile, run)
    monkeypatch.setattr(sim, "tile_links", counted)
    table = pa.RecordBatch.from_pydict({"k": keys, "fp": np.array(prints, np.uint64).view(np.int64)})
    found = set()
    for b in sim._compare(["k"], 2, 16)(iter([table.slice(0, 1000), table.slice(1000)])):
        found |= {frozenset(x) for x in zip(b.column("a").to_numpy().view(np.uint64).tolist(), b.column("b").to_numpy().view(np.uint64).tolist())}
    in_runs = [n for n in Counter(keys).values() if n > 1]
    assert sum(tiled) >= sum(in_runs) and max(tiled) <= sim.PACK
    for k in set(keys):
        mine = [p for x, p in zip(keys, prints) if x == k]
        root = {p: p for p in mine}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p
        for link in found:
            if link <= set(mine):
                a, b = link
                root[find(a)] = find(b)
        assert len({find(p) for p in mine}) == len(set(groups(mine)))


@pytest.mark.parametrize("how", [{}, {"group": 8, "tile": 4}, {"blocks": 8, "group": 30}, {"radius": 6, "blocks": 8}])
def test_components_of_fingerprints(spark, how):
    prints = sorted({*family(5, 200), *family(6, 80, flips=1), *(random.Random(7).getrandbits(64) for _ in range(100)), 0, 1})
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    known = sim.classes(spark.createDataFrame([(i, s) for i, s in enumerate(signed)], "doc_id long, fp long"), **how).collect()
    assert {r.fp: r.component_id for r in known} == dict(zip(signed, groups(prints, how.get("radius", 2))))


def test_long_chains_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in sim.connected(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}
    assert sim.connected(edges.where("false")).collect() == []


ROWS = [(1, "a b c d e"), (2, "A B  c\nd e"), (9, None), (8, ""), (7, " \n"), (3, "some other text of words"), (None, "a b c d e"), (None, "alone without an id"),
        (None, "alone without an id"), (5, "copy of a row"), (5, "copy of a row"), (6, "word " * 30_000)]


def test_edges(frame):
    got = sim.near_duplicates(frame(ROWS).withColumnRenamed("source", "fp")).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    assert by[1] == by[2] and {c for _, c in by[2]} == {1} and by[7] == by[8] == by[9] == {("0" * 16, 7)}
    assert {c for _, c in by[None]} == {1, None} and by[5] == {(f"{slow_print('copy of a row'):016x}", 5)}
    assert sim.near_duplicates(frame([])).collect() == []


def test_one_of_each(frame):
    docs = frame(ROWS).withColumn("fp", F.lit("own"))
    got = sim.one_of_each(docs)
    assert got.columns == docs.columns
    assert sorted([(r.doc_id, r.text) for r in got.collect()], key=str) == sorted(
        [(1, "a b c d e"), (7, " \n"), (3, "some other text of words"), (None, "alone without an id"), (5, "copy of a row"), (6, "word " * 30_000)], key=str)
    assert sim.one_of_each(frame([])).collect() == []


def test_query_equals_brute_force(spark, small):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    prints = [slow_print(t) for _, t in rows]
    want = {(d, f"{p:016x}", rows[g][0]) for (d, _), p, g in zip(rows, prints, groups(prints))}
    assert {tuple(r) for r in QUERIES["op7_simhash_tiles"](spark, small).select("doc_id", "fingerprint", "component_id").collect()} == want
