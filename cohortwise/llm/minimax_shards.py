"""Contiguous shards of least largest size.

Atomic groups (equal texts) lie on a line in the order of their 64-bit hash. The smallest capacity for which a greedy walk over the line
needs no more shards than there are is found by binary search, and the line is cut where that walk cuts.

The walk never needs all groups. It starts from the sums of BLOCKS equal stretches of the line. If stretches could be cut
anywhere, the best capacity would be some `low`; if nowhere, some `high`; the true one lies between. Only stretches in which a walk
with a capacity from that range may cut are divided further, each round by one aggregate over the written table of
groups, until these are single groups; then the search is exact. The driver holds sums of stretches, at most some
ten thousands, whatever the number of documents.

Rows are numbered inside a shard over parts of equal expected size (a hash of id and text), whose counts give each part's first slot,
so that a text with a third of all rows does not sit in one task.

Defined results: a missing text is an empty one (size 8 with the default overhead). A missing id is numbered like any other
value, first in its part. Repeated rows get slots of their own. With fewer groups than shards the last shards stay empty. Texts with
equal 64-bit hashes count as one group.
"""

from __future__ import annotations

import bisect

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm.common import stage

SHARDS, OVERHEAD = 24, 8
BLOCKS = 1 << 14
PARTS = 1 << 10


def cuts(sizes: list[int], capacity: int) -> list[int]:
    """Greedy walk: the index at which each further shard begins."""
    upto = np.cumsum(np.array(sizes, np.int64)).tolist() if sizes else []
    found, at = [], 0
    while at < len(sizes):
        before = upto[at - 1] if at else 0
        at = bisect.bisect_right(upto, before + capacity, lo=at)
        if at < len(sizes):
            found.append(at)
    return found


def smallest_capacity(sizes: list[int], shards: int) -> int:
    """Binary search for the smallest capacity that the greedy walk can keep to."""
    if not sizes:
        return 0
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if len(cuts(sizes, middle)) < shards else (middle + 1, high)
    return low


def _least_capacity(sizes: list[int], single: list[bool], shards: int) -> int:
    """A capacity below which no partition can go: as above, with stretches of several groups cut wherever it suits."""
    upto = np.cumsum(np.array(sizes, np.int64)).tolist()

    def walk(capacity: int) -> bool:
        at, used = 0, 0
        while at < upto[-1]:
            used += 1
            if used > shards:
                return False
            to = at + capacity
            if to < upto[-1]:
                k = bisect.bisect_right(upto, to)
                if single[k]:
                    to = upto[k - 1] if k else 0
            if to <= at:
                return False
            at = to
        return True

    low, high = -(-upto[-1] // shards), upto[-1]
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if walk(middle) else (middle + 1, high)
    return low


def _open(sizes: list[int], single: list[bool], shards: int, low: int, high: int) -> list[int]:
    """Stretches of several groups in which a walk with a capacity from low to high may cut.

    Walks only get further with more capacity: the k-th cut lies between that of a walk with `low` that stops at the ends of
    stretches, and that of a walk with `high` that may stop inside them.
    """
    upto = np.cumsum(np.array(sizes, np.int64)).tolist()
    near, far, found = 0, 0, set()
    for _ in range(shards - 1):
        k = bisect.bisect_right(upto, near + low) - 1
        near = max(near, upto[k]) if k >= 0 else near
        to = min(far + high, upto[-1])
        k = bisect.bisect_right(upto, to)
        if k < len(upto) and single[k]:
            to = upto[k - 1] if k else 0
        far = max(far, to)
        found.update(range(bisect.bisect_right(upto, near), min(bisect.bisect_left(upto, far), len(upto) - 1) + 1))
    return sorted(k for k in found if not single[k])


def boundaries(groups: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS) -> tuple[int, list[int]]:
    """The least largest size, and the hashes at which the second and later shards begin; groups has (h, size), a row per hash."""
    bits = blocks.bit_length() - 1
    shift = 64 - bits
    stretch = lambda s: F.shiftright("h", s)  # of the signed hash: the line runs from the lowest to the highest number
    got = groups.groupBy(stretch(shift).alias("k")).agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()
    spans = sorted((r["k"] << shift, shift, r["size"], r["n"] == 1) for r in got)
    while spans:
        sizes, single = [s[2] for s in spans], [s[3] for s in spans]
        low, high = _least_capacity(sizes, single, shards), smallest_capacity(sizes, shards)
        divide = [] if low == high else _open(sizes, single, shards, low, high)
        if not divide:
            return high, [spans[k][0] for k in cuts(sizes, high)]
        step = max(1, min(bits, (blocks // len(divide)).bit_length() - 1))
        done, finer = set(divide), []
        for width in sorted({spans[k][1] for k in divide}):
            chosen = [spans[k][0] >> width for k in divide if spans[k][1] == width]
            to = max(0, width - step)
            got = (groups.where(stretch(width).isin(chosen)).groupBy(stretch(to).alias("k"))
                   .agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect())
            finer += [(r["k"] << to, to, r["size"], r["n"] == 1 or to == 0) for r in got]
        spans = sorted([s for k, s in enumerate(spans) if k not in done] + finer)
    return 0, []


def place(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD, blocks: int = BLOCKS, parts: int = PARTS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of each document."""
    text = F.coalesce("text", F.lit(""))
    rows = stage(docs.select("doc_id", (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
                             F.xxhash64(text).alias("h")), "minimax-rows")
    groups = stage(rows.groupBy("h").agg(F.sum("size").alias("size")), "minimax-groups")
    _, starts = boundaries(groups, shards, blocks)
    shard = F.lit(0)
    for start in starts:
        shard = shard + (F.col("h") >= F.lit(start)).cast("int")
    rows = rows.withColumns({"shard": shard.cast("int"), "part": F.pmod(F.xxhash64("doc_id", "h", "size"), F.lit(parts)).cast("int")})
    counted = rows.groupBy("shard", "part").count()
    first = counted.select("shard", "part", (F.sum("count").over(Window.partitionBy("shard").orderBy("part")) - F.col("count")).alias("first"))
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy("h", "doc_id")) - 1
    return (rows.withColumn("inside", inside).join(first, ["shard", "part"])
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("inside")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard")))
