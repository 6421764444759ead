"""SimHash near-duplicates by tiled exact comparison.

A fingerprint's bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of the text's word shingles, repeats
included. Which fingerprints lie within the radius is found exactly: of BLOCKS equal blocks of bits, two fingerprints
that differ in at most `radius` bits agree in BLOCKS - radius, so that each choice of that many blocks is a key and only
equal keys can hold a link. Inside a key the fingerprints, in order of their population counts, are cut into tiles;
tile pairs whose counts lie further apart than the radius are skipped, the others are compared whole by exclusive-or
and bit counts in numpy. A key with more than `group` fingerprints is split before the shuffle into groups of one
population count and one hash part each, and each pair of such groups is a task's group of its own.

Defined results: a missing, empty or wordless text has fingerprint zero and links like any other. Fewer words than a
shingle: the whole sequence is hashed. Repeated rows share a component. Missing ids are passed over when the smallest
id of a component is taken; a component without any id has a missing component_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.llm.common import batch, stage, utf8

WORDS, RADIUS, SEED = 3, 2, 42
BLOCKS = 4
TILE, GROUP = 1024, 8192
#: Runs of a key up to this many fingerprints share tiles with others, of PACK_TILE fingerprints, packed up to PACK together.
SHORT_RUN, PACK, PACK_TILE = 64, 1024, 64


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """64-bit SimHash of a UTF-8 text; words are separated by ASCII white space, A-Z count as a-z."""
    parts = text.lower().split() if text else []
    if not parts:
        return 0
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(b" ".join(parts), SEED)
    line = b" ".join(parts)
    starts = [0, *accumulate(len(p) + 1 for p in parts)]
    digest, seed = xxhash.xxh64_intdigest, SEED
    total, size = np.zeros(64, np.int64), len(parts) - words + 1
    for at in range(0, size, 1 << 15):
        upto = min(size, at + (1 << 15))
        hashes = np.array([digest(line[a:b - 1], seed) for a, b in zip(starts[at:upto], starts[at + words:upto + words])], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > size, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = WORDS, into: str = "fp") -> DataFrame:
    """All columns of docs and the fingerprint as a signed 64-bit integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prints = np.array([fingerprint(t, words) for t in utf8(b.column(text))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(prints)], names=[*b.schema.names, into])
    return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField(into, T.LongType())]))


def tile_links(prints: np.ndarray, radius: int = RADIUS, tile: int = TILE, run: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """A forest with the components of all links among the given unsigned fingerprints, as two arrays.

    The forest keeps connection, and has fewer rows than there are fingerprints whatever the number of links. Given the run of each
    (distinct) fingerprint, only links inside a run count.
    """
    prints = np.unique(prints) if run is None else prints
    counts = np.bitwise_count(prints)
    order = np.argsort(counts, kind="stable")
    prints, counts = prints[order], counts[order]
    run = None if run is None else run[order]
    n = len(prints)
    roots = np.arange(n)
    for a in range(0, n, tile):
        left = prints[a:a + tile, None]
        for b in range(a, n, tile):
            if int(counts[b]) - int(counts[min(a + tile, n) - 1]) > radius:
                break
            near = np.bitwise_count(left ^ prints[None, b:b + tile]) <= radius
            if run is not None:
                near &= run[a:a + tile, None] == run[None, b:b + tile]
            i, j = np.nonzero(near)
            i, j = i + a, j + b
            _join(roots, i[i < j], j[i < j])
    child = np.flatnonzero(roots != np.arange(n))
    return prints[child], prints[roots[child]]


def _join(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of all pairs; roots[x] stays the smallest index of x's component."""
    while True:
        a, b = roots[i], roots[j]
        open_ = a != b
        if not open_.any():
            return
        i, j, a, b = i[open_], j[open_], a[open_], b[open_]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = roots[roots]
            if (up == roots).all():
                break
            roots[:] = up


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare(keys: list[str], radius: int, tile: int):
    """Links inside the runs of equal keys of a sorted partition, by tiles: long runs have their own, short ones share them."""
    def of(prints: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        sizes = ends - starts
        long_ = sizes > SHORT_RUN
        packed = np.repeat(~long_ & (sizes > 1), sizes)
        short, of_run = prints[packed], np.repeat(np.arange(len(sizes)), np.where(long_ | (sizes < 2), 0, sizes))
        # a pack ends where a run ends
        ends_of = np.flatnonzero(np.append(of_run[1:] != of_run[:-1], True)) + 1 if len(short) else np.empty(0, int)
        cuts = np.unique(ends_of[np.maximum(np.searchsorted(ends_of, np.arange(PACK, len(short) + PACK, PACK), "right") - 1, 0)]) if len(short) else []
        found = [(np.empty(0, np.uint64),) * 2]
        found += [tile_links(short[a:b], radius, PACK_TILE, of_run[a:b]) for a, b in zip([0, *cuts], cuts)]
        found += [tile_links(prints[s:e], radius, tile) for s, e in zip(starts[long_].tolist(), ends[long_].tolist())]
        a, b = (np.concatenate(x) for x in zip(*found))
        if len(a):
            yield batch(_LINK, a=a.view(np.int64), b=b.view(np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            table = [b.column(k).to_numpy(zero_copy_only=False) for k in [*keys, "fp"]]
            if held is not None:
                table = [np.concatenate([h, t]) for h, t in zip(held, table)]
            prints = table[-1].astype(np.int64).view(np.uint64)
            new = np.ones(len(prints), bool)
            new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in table[:-1]])
            starts = np.flatnonzero(new)
            last = int(starts[-1])  # the run that the next batch may go on with
            yield from of(prints[:last], starts[:-1], starts[1:])
            held = [c[last:] for c in table]
        if held is not None:
            yield from of(held[-1].astype(np.int64).view(np.uint64), np.array([0]), np.array([len(held[-1])]))
    return run


def links(prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE, group: int = GROUP) -> DataFrame:
    """Links (a, b) that connect all fingerprints (distinct, column fp) within the radius of each other."""
    if not 0 < blocks - radius or 64 % blocks:
        raise ValueError("blocks has to divide 64 and to be larger than the radius")
    width = 64 // blocks
    part = lambda k: F.shiftrightunsigned("fp", width * k).bitwiseAND((1 << width) - 1)
    keys = []
    for chosen in combinations(range(blocks), blocks - radius):
        value = part(chosen[0])
        for k in chosen[1:]:
            value = F.shiftleft(value, width).bitwiseOR(part(k))
        keys.append(F.struct(F.lit(len(keys)).alias("choice"), value.alias("value")))
    keyed = prints.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.choice", "k.value")
    large = keyed.groupBy("choice", "value").count().where(F.col("count") > group).select(
        "choice", "value", F.ceil(F.col("count") / group).cast("int").alias("parts"))
    pop = F.bit_count("fp")
    mine = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    pair = lambda p, i, q, j: F.struct(p.cast("int").alias("p"), i.cast("int").alias("i"), q.cast("int").alias("q"), j.cast("int").alias("j"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    below = lambda d: F.transform(F.filter(others, lambda j: j >= mine) if d == 0 else others, lambda j: pair(pop, mine, pop + d, j))
    above = lambda d: F.transform(F.filter(others, lambda i: i <= mine) if d == 0 else others, lambda i: pair(pop - d, i, pop, mine))
    none = F.lit(-1)
    pairs = F.when(F.col("parts").isNull(), F.array(pair(none, none, none, none))).otherwise(
        F.array_distinct(F.concat(*[f(d) for d in range(radius + 1) for f in (below, above)])))
    tiles = (keyed.join(large, ["choice", "value"], "left").select("fp", "choice", "value", F.explode(pairs).alias("t"))
             .select("fp", "choice", "value", "t.p", "t.i", "t.q", "t.j"))
    names = ["choice", "value", "p", "i", "q", "j"]
    dealt = tiles.repartition(*names).sortWithinPartitions(*names)
    return dealt.mapInArrow(_compare(names, radius, tile), "a long, b long").distinct()


def connected(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the edges (a, b); the root is the component's smallest node.

    Large-star and small-star rounds, each written to the shared folder, until nothing changes. Stars that grow large are
    joined by key with one row per node on the other side, which adaptive execution can split.
    """
    edges = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")
    mark = _mark(edges)
    for _ in range(most_rounds):
        if not mark[0]:
            break
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                 .union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct())
        edges = stage(small, "cc-edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(edges.select(F.col("b"), F.col("b")).distinct())


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def classes(prints: DataFrame, doc_id: str = "doc_id", radius: int = RADIUS, **how) -> DataFrame:
    """For each distinct fingerprint of prints (doc_id, fp): fp, root, component_id, and how many rows have that id."""
    each = stage(prints.groupBy("fp").agg(F.min(doc_id).alias("low")), "simhash-distinct")
    roots = connected(links(each.select("fp"), radius, **how))
    rooted = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "low")
    least = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, **how) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each document."""
    prints = stage(with_fingerprint(docs.select("doc_id", "text"), words=words).select("doc_id", "fp"), "simhash-prints")
    known = classes(prints, radius=radius, **how)
    return prints.join(known, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, **how) -> DataFrame:
    """One document of each component of near-duplicates, that with the smallest id, with its own columns.

    Of several rows with that id, or of a component without any id, one is kept.
    """
    text_hash = "_simhash_text"
    prints = with_fingerprint(docs.select("doc_id", "text"), words=words)
    prints = stage(prints.select("doc_id", F.xxhash64("text").alias("th"), "fp"), "simhash-prints")
    chosen = prints.join(classes(prints, radius=radius, **how), "fp").where("doc_id <=> component_id").select("root", "doc_id", "th")
    chosen = stage(chosen, "simhash-chosen")
    repeated = not chosen.groupBy("doc_id", "th").count().where("count > 1").isEmpty()
    keys = chosen.groupBy("root").agg(F.min(F.struct("doc_id", "th")).alias("k")).select(
        F.col("k.doc_id").alias("_simhash_id"), F.col("k.th").alias("_simhash_th"))
    rows = docs.withColumn(text_hash, F.xxhash64("text"))
    rows = rows.join(keys, F.col("doc_id").eqNullSafe(F.col("_simhash_id")) & (F.col(text_hash) == F.col("_simhash_th")), "left_semi")
    rows = rows.dropDuplicates(["doc_id", text_hash]) if repeated else rows
    return rows.drop(text_hash)
