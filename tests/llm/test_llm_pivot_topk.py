import math
import random

import numpy as np
from pyspark.sql import functions as F

from cohortwise.llm import pivot_topk

ROWS = "vec_id long, embedding array<double>"


def brute(rows, k=5, every=50):
    able = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, seen = [], set()
    for q, v in able:
        if q % every or (q, tuple(v)) in seen:
            continue
        seen.add((q, tuple(v)))
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in able if i != q)[:k]
        out += [(q, rank, i, max(-2 ** 63, min(2 ** 63 - 1, -s))) for rank, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def found(df, **how):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in pivot_topk.search(df, **how).collect())


def test_given_table(spark, small):
    df = spark.read.parquet(f"{small}/embeddings.parquet")
    assert found(df) == brute([(r.vec_id, r.embedding) for r in df.collect()])


def test_many_pivots_annuli_and_blocks(spark, monkeypatch):
    for name, value in (("PER_PIVOT", 20), ("PER_BLOCK", 64 * 4), ("ASKS", 8), ("SAMPLE", 60), ("FIRST", 1)):
        monkeypatch.setattr(pivot_topk, name, value)
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(12, 4)) * 3
    rows = [(int(i), (middle[i % 12] + rng.normal(size=4) * 0.2).tolist()) for i in range(900)]
    rows += [(900 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(500)]  # one very common vector
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    assert found(df, every=20) == brute(rows, every=20)
    # the bounds do leave annuli out
    spots, index, annuli, width = pivot_topk.build(df)
    assert len(index.pivots) > 10 and annuli.count() > len(index.pivots)
    assert annuli.agg(F.max("blocks")).first()[0] > 1


def test_bounds_hold(spark):
    rng = random.Random(3)
    sample = np.array([[rng.randint(-300, 300) for _ in range(3)] for _ in range(200)], float)
    index = pivot_topk.Index.fit(np.arange(200), sample, 40 * pivot_topk.PER_PIVOT, "<i2")
    pivot, r = index.nearest(sample)
    annuli = {"pivot": pivot, "low": r, "high": r, "norm": (sample ** 2).sum(1)}
    assert (index.bounds(sample[:50], annuli) >= sample[:50] @ sample.T).all()


def test_odd_rows(spark):
    rows = [(0, [0.5, -0.25]), (50, [0.5, -0.25]), (50, [0.5, -0.25]), (100, []), (150, [1.0]), (1, None), (None, [1.0, 1.0]), (2, [None, 1.0]), (3, [float("nan"), 0.0]),
            (4, [float("inf"), 0.0]), (5, [-0.001, 0.001]), (5, [-0.001, 0.001]), (200, [1e30, -1e30]), (6, [1e25, 1.0, 3.0]), (-50, [0.1, 0.2])]
    assert found(spark.createDataFrame(rows, ROWS)) == brute(rows)
    assert found(spark.createDataFrame([], ROWS)) == []
    assert found(spark.createDataFrame([(7, [1.0]), (50, [1.0])], ROWS)) == [(50, 1, 7, 65536)]


def test_clashing_columns(spark):
    rows = [(i, [i / 7, 1 - i / 9]) for i in range(60)]
    clash = spark.createDataFrame(rows, ROWS).withColumns({c: F.lit("?") for c in ("v", "pivot", "r", "norm", "part", "rank", "score")})
    assert found(clash, every=10) == brute(rows, every=10)
