"""Exact top-k by inner product over an index of pivots and distances.

Components are floor(256 * x), kept as the narrowest of 16 or 32-bit integers or doubles that holds a table's values. Every vector is
keyed by its nearest pivot and its distance from it. A pivot's distances are cut at quantiles into annuli; a long annulus
is dealt into blocks. A vector v at distance r from pivot p is at least |d(q, p) - r| from a query q, so that
    <q, v> = (|q|^2 + |v|^2 - |q - v|^2) / 2 <= (|q|^2 + N - gap^2) / 2,     <q, v> <= <q, p> + |q| r
with N the largest square in the annulus and gap the distance of d(q, p) from the annulus's distances. Each query takes its annuli
in order of that bound: first the best few, then those whose bound still reaches its k-th score. The first k-th score is that over
the sample of rows from which the pivots come. What no bound reaches cannot be in the result, ties included, so the result is exact.

Bounds: the pivots are fitted on at most SAMPLE rows (those with the smallest hashes of their id); there are at most PIVOTS pivots of
at most BANDS annuli, which go to every task. All rows are indexed.

Defined results: rows without id, without vector, or with a missing, infinite or NaN component (also after the factor 256) take no
part. A shorter vector counts as padded with zeros, an empty one as zero. A row is no candidate for queries of its own id. Repeated
rows are candidates as often as they occur, a repeated query row is answered once; queries of one id with different vectors are
answered apart, told apart by `vec_hash`. Scores beyond 64 bits are ranked exactly up to 38
digits, longer ones count as equal; the nearest long is returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm.common import stage

K, EVERY = 5, 50
SAMPLE, PIVOTS, BANDS = 2048, 256, 64
#: Vectors of a pivot and of an annulus aimed at, and the most components of a block.
PER_PIVOT, PER_BLOCK = 1024, 1 << 19
#: Annuli that a query visits before the bounds are looked at again.
FIRST = 4
#: Queries that one task compares with a block.
ASKS = 1 << 16
#: Share of a bound that rounding of distances may take.
SLACK = 1e-9
_MOST = 10 ** 38 - 1
_KINDS = {2: "<i2", 4: "<i4", 8: "<f8"}


def scaled(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): ids and 256 * x, which tasks round down, for rows that take part."""
    whole = F.transform(embedding, lambda x: x.cast("double") * F.lit(256.0))
    big = F.lit(1.7e308)
    rows = table.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("v"))
    return rows.where(F.forall("v", lambda x: F.coalesce(F.abs(x) <= big, F.lit(False))))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of whole doubles, padded with zeros."""
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(float))
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _pack(rows: np.ndarray, kind: str) -> list[bytes]:
    return [r.tobytes() for r in rows.astype(kind)]


def _unpack(values: list[bytes], width: int) -> np.ndarray:
    if not width:
        return np.zeros((len(values), 0))
    return np.frombuffer(b"".join(values), _KINDS[len(values[0]) // width]).reshape(-1, width).astype(float)


def inner(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole doubles: in doubles where no partial sum can round, else in Python's integers."""
    most = max(1.0, float(np.abs(queries).max(initial=0))) * max(1.0, float(np.abs(rows).max(initial=0))) * max(1, rows.shape[1])
    if most < 2 ** 53:
        return (queries @ rows.T).astype(np.int64)
    to_int = np.frompyfunc(int, 1, 1)
    return to_int(queries).dot(to_int(rows.T))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k and scores.dtype != object:
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
    else:
        near = np.arange(len(scores))
    order = sorted(near.tolist(), key=lambda i: (-scores[i], ids[i]))
    return np.array(order[:k], int)


class Index:
    """Pivots, and the annuli of each: what every task needs to know of the index."""

    def __init__(self, pivots: np.ndarray, ids: np.ndarray, sample: np.ndarray, kind: str):
        self.pivots, self.ids, self.sample, self.kind = pivots, ids, sample, kind

    @classmethod
    def fit(cls, ids: np.ndarray, sample: np.ndarray, rows: int, kind: str) -> Index:
        """Pivots from a few rounds of means over the sample, started from rows far from each other."""
        wanted = max(1, min(PIVOTS, -(-rows // PER_PIVOT), len(sample)))
        # sample rows of a scale that rounding leaves intact
        pivots = sample[:1].copy() if len(sample) else np.zeros((1, sample.shape[1]))
        far = np.full(len(sample), np.inf)
        while len(pivots) < wanted:
            far = np.minimum(far, ((sample - pivots[-1]) ** 2).sum(1))
            if far.max() <= 0:
                break
            pivots = np.vstack([pivots, sample[int(far.argmax())]])
        for _ in range(6 if len(sample) else 0):
            near = cls._distances(sample, pivots).argmin(1)
            total = np.zeros_like(pivots)
            np.add.at(total, near, sample)
            count = np.bincount(near, minlength=len(pivots))
            pivots = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], pivots)
        return cls(pivots, ids, sample, kind)

    @staticmethod
    def _distances(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
        square = (rows ** 2).sum(1)[:, None] + (pivots ** 2).sum(1)[None] - 2 * rows @ pivots.T
        return np.sqrt(np.maximum(square, 0))

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest pivot and the distance from it, recomputed from the differences for its precision."""
        pivot = self._distances(rows, self.pivots).argmin(1)
        return pivot, np.sqrt(((rows - self.pivots[pivot]) ** 2).sum(1))

    def bounds(self, queries: np.ndarray, annuli: dict[str, np.ndarray]) -> np.ndarray:
        """Upper bound of the inner products of each query with the vectors of each annulus."""
        pivot, low, high, norm = (annuli[c] for c in ("pivot", "low", "high", "norm"))
        apart = np.array([np.sqrt(((q - self.pivots) ** 2).sum(1)) for q in queries]).reshape(len(queries), -1)[:, pivot]
        square = (queries ** 2).sum(1)[:, None]
        scale = apart + high + 1
        gap = np.maximum(np.maximum(apart - high, low - apart) - SLACK * scale, 0)
        by_distance = (square + norm - gap ** 2) / 2
        by_angle = (queries @ self.pivots.T)[:, pivot] + np.sqrt(square) * high
        size = square + norm + (np.abs(self.pivots).max(initial=0) + 1) ** 2 + scale ** 2
        return np.minimum(by_distance, by_angle) + SLACK * size + 1e-6

    def first_scores(self, queries: np.ndarray, ids: np.ndarray, k: int) -> list[float]:
        """The k-th score of each query over the sample: no more than its k-th score over all rows."""
        out = []
        for q, own in zip(queries, ids):
            scores = inner(q[None], self.sample[self.ids != own])[0] if len(self.sample) else np.empty(0)
            low = float(scores[best(scores, np.arange(len(scores)), k)[-1]]) if len(scores) >= k else -np.inf
            out.append(low if abs(low) < 2 ** 53 else low - abs(low) * 1e-12)
        return out


_SPOT = "vec_id long, v binary, pivot int, r double, norm double, part long"
_ASK = "pivot int, band int, block int, vec_id long, v binary, qhash long, bound double, floor double, place int"
_FOUND = pa.schema([("query_id", pa.int64()), ("qhash", pa.int64()), ("vec_id", pa.int64()), ("score", pa.decimal128(38, 0)), ("floor", pa.float64())])


def build(table: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, Index, DataFrame, int]:
    """The index: all rows with pivot, distance, band and block; pivots and sample; one row per annulus; the width of a vector."""
    rows = scaled(table, vec_id, embedding)
    shape = rows.select(F.count("*").alias("n"), F.max(F.size("v")).alias("width"),
                        F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    width, most = int(shape.width or 0), float(shape.most or 0)
    kind = "<i2" if most < 2 ** 15 else "<i4" if most < 2 ** 31 else "<f8"
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(SAMPLE).toArrow()
    sample = _matrix(picked.column("v").combine_chunks(), width) if picked.num_rows else np.zeros((0, width))
    index = Index.fit(picked.column("vec_id").to_numpy(), sample, shape.n, kind)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column("v"), width)
            pivot, r = index.nearest(v)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array(_pack(v, kind), pa.binary()), pa.array(pivot.astype(np.int32)), pa.array(r),
                 pa.array((v ** 2).sum(1)), b.column("part")], names=["vec_id", "v", "pivot", "r", "norm", "part"])

    # the row's number within its task deals equal vectors evenly over the blocks; it is written, so that it stays
    spots = stage(rows.withColumn("part", F.monotonically_increasing_id()).mapInArrow(place, _SPOT), "pivot-spots")
    # at most PIVOTS rows: where each pivot's distances are cut
    shares = [i / BANDS for i in range(1, BANDS)]
    cells = spots.groupBy("pivot").agg(F.count("*").alias("n"), F.percentile_approx("r", shares, 1000).alias("e"))
    bands = F.least(F.lit(BANDS), F.ceil(F.col("n") / PER_PIVOT)).cast("int")
    edges = F.when(bands > 1, F.array_distinct(F.transform(F.sequence(F.lit(1), bands - 1), lambda i: F.element_at("e", F.floor(i * BANDS / bands).cast("int")))))
    cells = stage(cells.select("pivot", F.coalesce(edges, F.array().cast("array<double>")).alias("edges")), "pivot-cells")
    spots = spots.join(cells, "pivot").withColumn("band", F.size(F.filter("edges", lambda e: e < F.col("r"))).cast("int")).drop("edges")
    per_block = max(64, PER_BLOCK // max(1, width))
    annuli = spots.groupBy("pivot", "band").agg(F.min("r").alias("low"), F.max("r").alias("high"), F.max("norm").alias("norm"),
                                                F.ceil(F.count("*") / per_block).cast("int").alias("blocks"))
    return spots, index, stage(annuli, "pivot-annuli"), width


def search(table: DataFrame, k: int = K, every: int = EVERY, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score and vec_hash of the k best candidates of every query."""
    spots, index, annuli, width = build(table, vec_id, embedding)
    known = annuli.orderBy("pivot", "band").toPandas()  # at most PIVOTS * BANDS rows
    table_of = {c: known[c].to_numpy() for c in ("pivot", "band", "low", "high", "norm", "blocks")}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's annuli in order of their bounds, best first, as far as the sample's scores let them count."""
        for b in batches:
            for s in range(0, b.num_rows, 64):
                part = b.slice(s, 64)
                q, ids = _unpack(part.column("v").to_pylist(), width), part.column("vec_id").to_numpy()
                bound = index.bounds(q, table_of)
                floor = index.first_scores(q, ids, k)
                for i, low in enumerate(floor):
                    order = np.argsort(-bound[i], kind="stable")
                    order = order[bound[i][order] >= low]
                    many = table_of["blocks"][order]
                    at, block = np.repeat(order, many), np.concatenate([np.arange(m) for m in many]) if len(many) else many
                    n = len(at)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(table_of["pivot"][at].astype(np.int32)), pa.array(table_of["band"][at].astype(np.int32)), pa.array(block.astype(np.int32)),
                         pa.array(np.full(n, ids[i])), pa.array([part.column("v")[i].as_py()] * n, pa.binary()), pa.array([part.column("qhash")[i].as_py()] * n, pa.int64()),
                         pa.array(bound[i][at]), pa.array(np.full(n, low)), pa.array(np.repeat(np.arange(len(order)), many).astype(np.int32))],
                        names=["pivot", "band", "block", "vec_id", "v", "qhash", "bound", "floor", "place"])

    rows = spots.join(annuli.select("pivot", "band", "blocks"), ["pivot", "band"]).withColumn("block", F.pmod("part", "blocks").cast("int"))
    queries = spots.where(F.col("vec_id") % every == 0).select("vec_id", "v", F.xxhash64("v").alias("qhash")).dropDuplicates(["vec_id", "v"])
    asked = stage(queries.mapInArrow(ask, _ASK), "pivot-asked")
    found = stage(_visit(rows, asked.where(F.col("place") < FIRST), width, k), "pivot-found")
    # the k-th score now known is the bar for what is left
    ranked = Window.partitionBy("query_id", "qhash").orderBy(F.col("score").desc(), "vec_id")
    bar = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") == k).select(
        F.col("query_id").alias("vec_id"), "qhash", F.col("score").cast("double").alias("bar"))
    left = (asked.where(F.col("place") >= FIRST).join(bar, ["vec_id", "qhash"], "left")
            .withColumn("floor", F.greatest("floor", F.coalesce("bar", "floor"))).where("bound >= floor").drop("bar"))
    found = found.unionByName(_visit(rows, left, width, k))
    top = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    low, high = (F.lit(x).cast("decimal(38,0)") for x in (str(-2 ** 63), str(2 ** 63 - 1)))
    return top.select("query_id", "rank", "vec_id", F.greatest(low, F.least(high, "score")).cast("long").alias("score"), F.col("qhash").alias("vec_hash"))


def _visit(rows: DataFrame, asked: DataFrame, width: int, k: int) -> DataFrame:
    """The k best of each block for each query that asks for it. A task holds one block and reads its queries as a stream.

    Where more than ASKS queries ask for an annulus, each of its blocks goes to several tasks with a part of the queries each.
    """
    none = lambda kind: F.lit(None).cast(kind)
    wanted = asked.where("block = 0").groupBy("pivot", "band").agg(F.ceil(F.count("*") / ASKS).cast("int").alias("parts"))
    wanted = stage(wanted, "pivot-wanted")  # at most PIVOTS * BANDS rows
    data = rows.join(wanted, ["pivot", "band"]).select("*", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("share"))
    data = data.select("pivot", "band", "block", "share", F.lit(0).alias("ask"), "vec_id", "v", none("long").alias("qhash"), none("double").alias("floor"))
    asks = asked.join(wanted, ["pivot", "band"]).withColumn("share", F.pmod(F.xxhash64("vec_id", "qhash"), "parts").cast("int"))
    asks = asks.select("pivot", "band", "block", "share", F.lit(1).alias("ask"), "vec_id", "v", "qhash", "floor")
    spot = ["pivot", "band", "block", "share"]
    dealt = data.unionByName(asks).repartition(*spot).sortWithinPartitions(*spot, "ask")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, held, block = None, [], [], None
        for b in batches:
            spot = [b.column(c).to_numpy(zero_copy_only=False) for c in ("pivot", "band", "block", "share", "ask")]
            if not b.num_rows:
                continue
            edge = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in spot])) + 1
            for s, e in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows]):
                here, part = tuple(int(c[s]) for c in spot[:4]), b.slice(s, e - s)
                if here != key:
                    key, ids, held, block = here, [], [], None
                if not spot[4][s]:
                    ids.append(part.column("vec_id").to_numpy())
                    held += part.column("v").to_pylist()
                elif held:
                    if block is None:
                        block, ids = _unpack(held, width), [np.concatenate(ids)]
                    yield from _answers(part, block, ids[0], width, k)
    return dealt.mapInArrow(run, "query_id long, qhash long, vec_id long, score decimal(38,0), floor double")


def _answers(part: pa.RecordBatch, block: np.ndarray, ids: np.ndarray, width: int, k: int) -> Iterator[pa.RecordBatch]:
    queries, floors = part.column("vec_id").to_numpy(), part.column("floor").to_numpy()
    for s in range(0, part.num_rows, 256):
        scores = inner(_unpack(part.column("v").slice(s, 256).to_pylist(), width), block)
        at, who, what = [], [], []
        for i, row in enumerate(scores):
            able = np.flatnonzero((ids != queries[s + i]) & (row >= floors[s + i]))
            chosen = able[best(row[able], ids[able], k)]
            at += [s + i] * len(chosen)
            who.append(ids[chosen])
            what += [max(-_MOST, min(_MOST, int(x))) for x in row[chosen]]
        if at:
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries[at]), part.column("qhash").take(pa.array(at)), pa.array(np.concatenate(who)),
                 pa.array(what, pa.decimal128(38, 0)), pa.array(floors[at])], schema=_FOUND)
