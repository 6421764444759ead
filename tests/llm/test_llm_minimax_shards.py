import zlib
from collections import Counter, defaultdict
from itertools import combinations

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from cohortwise.llm import minimax_shards as shards
from cohortwise.llm.queries import QUERIES


def largest(sizes, starts):
    edges = [0, *starts, len(sizes)]
    return max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:]))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=9), st.integers(1, 4))
def test_capacity_is_that_of_the_best_of_all_partitions(sizes, n):
    best = min(largest(sizes, cut) for k in range(min(n, len(sizes))) for cut in combinations(range(1, len(sizes)), k))
    capacity = shards.smallest_capacity(sizes, n)
    cut = shards.cuts(sizes, capacity)
    assert capacity == best and len(cut) < n and largest(sizes, cut) <= capacity


def greedy(sizes, n):
    low, high = max(sizes), sum(sizes)
    while low < high:
        m = (low + high) // 2
        used, a = 1, 0
        for x in sizes:
            used, a = (used + 1, x) if a + x > m else (used, a + x)
        low, high = (low, m) if used <= n else (m + 1, high)
    out, a = [], 0
    for i, x in enumerate(sizes):
        if a + x > low:
            out.append(i)
            a = 0
        a += x
    return low, out


@pytest.mark.parametrize("blocks", [4, 64, 1 << 14])
@pytest.mark.parametrize("hot", [0, 40_000])
def test_coarse_to_fine_finds_the_same_cuts(spark, blocks, hot):
    rows = [(xxhash.xxh64_intdigest(str(i)) - (1 << 63), 1 + i * i % 97 + (hot if i == 311 else 0)) for i in range(700)]
    line = sorted(rows)
    capacity, starts = greedy([s for _, s in line], 7)
    groups = spark.createDataFrame(rows, "h long, size long")
    found, at = shards.boundaries(groups, 7, blocks)  # a shard may begin anywhere between the last group before and its first
    assert (found, [sum(h < a for h, _ in line) for a in at]) == (capacity, starts)


def check(rows, got, n):
    text = {}
    sizes, at = Counter(), {}
    for doc_id, t in rows:
        h = xxhash.xxh64_intdigest((t or "").encode(), 42)
        at[t or ""] = h - (1 << 64) if h >> 63 else h
        sizes[at[t or ""]] += len((t or "").encode()) + 8
    line = sorted(sizes)
    _, starts = greedy([sizes[h] for h in line], n) if line else (0, [])
    shard = {h: sum(h >= line[s] for s in starts) for h in line}
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()), "bytes", shard[at[t or ""]], None) for d, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    return text


def test_edges(frame):
    rows = [(1, None), (2, ""), (3, "same"), (4, "same"), (4, "same"), (None, "x"), (None, "x"), (7, "long " * 50_000), (8, "é")]
    check(rows, shards.place(frame(rows).withColumnRenamed("source", "shard"), shards=3).collect(), 3)


def test_hot_text_and_few_groups(frame):
    rows = [(i, "copy") for i in range(400)] + [(400 + i, f"text {i}") for i in range(800)]
    check(rows, shards.place(frame(rows), shards=5, blocks=16, parts=8).collect(), 5)
    check(rows[:400], shards.place(frame(rows[:400]), shards=5).collect(), 5)
    assert shards.place(frame([])).collect() == []


def test_query_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    check(rows, QUERIES["op5_minimax_shards"](spark, small).collect(), 24)
