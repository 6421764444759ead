"""Document quality by a regularised quadratic discriminant.

Each class has a normal density over transformed document statistics. Its covariance is shrunk towards the pooled one
and then towards a multiple of the identity; the score comes from the difference of the log-densities, that is of Mahalanobis distances and
log-determinants, both read off Cholesky factors that are computed once. The difference is put on the scale of probabilities by a
logistic curve of one slope and one offset, fitted to a bounded sample of the rows that may be learned from.

Counts, means and covariances come from all labelled rows that may be learned from (see common.held_out): each task sums
products of its rows, and Spark adds up these sums. Only text and quality are used.

Defined results: a missing text has the statistics of an empty one. Rows without a quality label teach nothing; an id that is labelled
more than once counts once for each label row. If a class has no labelled rows, the score is the share of label 1 among
them, and 0.5 without any. Repeated rows score alike.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.llm.common import held_out, stage, utf8

POOLED, IDENTITY = 0.2, 0.02
THRESHOLD = 0.3
#: Labelled rows, about, from which slope and offset of the logistic curve are fitted; twice as many at most.
CALIBRATION_ROWS = 20_000

# Frequent function words.
FUNCTION_WORDS = frozenset(w.encode() for w in (
    "the of and to in a is that it for on was as with be by are this at an from "
    "de la le et les des en un du une que est pour dans qui par sur au pas avec "
    "der die und den von zu das mit sich auf für ist im nicht ein eine "
    "el los del se las por con no una su para es al lo como").split())

_CLASSES = np.full(256, 5, np.int64)  # other ASCII punctuation
_CLASSES[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = 0
_CLASSES[0x41:0x5B] = 1
_CLASSES[0x30:0x3A] = 2
_CLASSES[[0x20, *range(0x09, 0x0E)]] = 3
_CLASSES[[ord(c) for c in "#*$%&|<>"]] = 4
_SENTENCE = [ord(c) for c in ".!?"]

STATISTICS = ("words", "word_length", "upper", "digits", "symbols", "punctuation", "exclamations", "function_words", "distinct_words",
              "top_word", "repeated_next", "repeated_lines", "line_words", "unfinished_lines", "sentence_words", "deflated", "pipes", "long_words")


def _share(part: float, whole: float) -> float:
    """Log odds of a share, drawn towards the middle by half a count."""
    return float(np.log((part + 0.5) / (max(whole - part, 0.0) + 0.5)))


def statistics(text: bytes | None) -> list[float]:
    """Transformed statistics of a UTF-8 text, in the order of STATISTICS."""
    text = text or b""
    words = text.split()
    n = len(words)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(_CLASSES, counts, 6)
    size = len(text) - kinds[3]
    lower = [w.strip(b".,;:!?").lower() for w in words]
    met = Counter(lower)
    lines = [x for line in text.split(b"\n") if (x := line.strip())]
    known = sum(met[w] for w in FUNCTION_WORDS if w in met)
    packed = len(zlib.compress(text, 1)) if text else 0
    return [
        float(np.log1p(n)), float(np.log1p(size / n)) if n else 0.0, _share(kinds[1], kinds[0] + kinds[1]), _share(kinds[2], size), _share(kinds[4], size),
        _share(kinds[5], size), _share(counts[0x21], size), _share(known, n), _share(len(met), n),
        _share(max(met.values(), default=0), n), _share(sum(a == b for a, b in zip(lower, lower[1:])), n), _share(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(n / len(lines))) if lines else 0.0, _share(sum(x[-1] not in _SENTENCE for x in lines), len(lines)),
        float(np.log1p(n / (1 + int(counts[_SENTENCE].sum())))), float(np.log((packed + 20) / (len(text) + 20))), _share(counts[0x7C], n),
        _share(sum(len(w) > 20 for w in words), n)]


def with_statistics(docs: DataFrame, text: str = "text", into: str = "statistics") -> DataFrame:
    """All columns of docs and the array of statistics."""
    kept = [f for f in docs.schema if f.name != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [statistics(t) for t in utf8(b.column(text))]
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(rows, pa.list_(pa.float64()))], names=[*[f.name for f in kept], into])
    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.ArrayType(T.DoubleType()))]))


@dataclass
class Model:
    """Cholesky factors of both classes' covariances, and the logistic curve over the log-density difference."""

    prior: float
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    slope: float = 1.0
    offset: float = 0.0

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, for each row."""
        out = []
        for mean, factor in zip(self.means, self.factors):
            z = np.linalg.solve(factor, (x - mean).T)
            out.append(-0.5 * (z ** 2).sum(axis=0) - np.log(np.diag(factor)).sum())
        return out[1] - out[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.factors is None:
            return np.full(len(x), self.prior)
        return _logistic(self.slope * self.difference(x) + self.offset)


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def discriminant(n: np.ndarray, sums: np.ndarray, products: np.ndarray, pooled: float = POOLED, identity: float = IDENTITY) -> Model:
    """From each class's count, sum and sum of outer products to its mean and shrunken covariance's Cholesky factor."""
    total = n.sum()
    if not total:
        return Model(0.5)
    if (n == 0).any():
        return Model(float(n[1] / total))
    means = sums / n[:, None]
    scatter = products - n[:, None, None] * means[:, :, None] * means[:, None, :]
    common = scatter.sum(axis=0) / total
    spread = np.sqrt(np.maximum(np.diag(common), 1e-6))
    scale = np.outer(spread, spread)
    factors = []
    for c in range(2):
        own = (1 - pooled) * scatter[c] / n[c] + pooled * common
        own = own / scale  # shrink towards the identity on the scale of the pooled deviations
        own = (1 - identity) * own + identity * max(np.trace(own) / len(own), 1e-6) * np.eye(len(own))
        factors.append(np.linalg.cholesky(own * scale))
    return Model(float(n[1] / total), means, np.array(factors), 1.0, float(np.log(n[1] / n[0])))


def calibrate(model: Model, x: np.ndarray, y: np.ndarray, rounds: int = 50) -> Model:
    """Slope and offset by Newton steps on the likelihood, with a weak pull of the slope towards zero."""
    if model.factors is None or not len(y) or y.min() == y.max():
        return model
    d = model.difference(x)
    unit = max(float(np.std(d)), 1e-9)
    design, beta, pull = np.stack([d / unit, np.ones(len(d))], axis=1), np.array([1.0, 0.0]), np.diag([1e-2, 1e-6])
    value = lambda b: float(np.logaddexp(0, np.where(y == 1, -1, 1) * (design @ b)).sum() + 0.5 * b @ pull @ b)
    for _ in range(rounds):
        p = _logistic(design @ beta)
        slope = design.T @ (p - y) + pull @ beta
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + pull + 1e-9 * np.eye(2), slope)
        size = 1.0
        while size > 1e-6 and value(beta - size * step) > value(beta):
            size /= 2
        beta = beta - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    model.slope, model.offset = float(beta[0] / unit), float(beta[1])
    return model


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(STATISTICS)
    n, sums, products = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for b in batches:
        if not b.num_rows:
            continue
        x = b.column("statistics").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        y = b.column("quality").to_numpy(zero_copy_only=False)
        for c in range(2):
            own = x[y == c]
            n[c] += len(own)
            sums[c] += own.sum(axis=0)
            products[c] += own.T @ own
    for c in range(2):
        values = np.concatenate([[n[c]], sums[c], products[c].ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), c), pa.int32()), pa.array(np.arange(len(values)), pa.int32()), pa.array(values)], names=["c", "k", "v"])


def learn(described: DataFrame, labels: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """Fit to described (doc_id, statistics) and labels (doc_id, quality)."""
    marked = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
    rows = described.join(marked, "doc_id").select("doc_id", "statistics", "quality")
    rows = stage(rows, "qda-labelled")
    d = len(STATISTICS)
    got = np.zeros((2, 1 + d + d * d))
    for r in rows.select("statistics", "quality").mapInArrow(_sums, "c int, k int, v double").groupBy("c", "k").agg(F.sum("v").alias("v")).collect():
        got[r["c"], r["k"]] = r["v"]
    model = discriminant(got[:, 0], got[:, 1:1 + d], got[:, 1 + d:].reshape(2, d, d))
    if model.factors is None:
        return model
    # by a share of the hash, not by a sort, which would send this many rows of each partition; the limit only guards against ids that repeat
    share = min(1 << 20, int(np.ceil(calibration_rows / got[:, 0].sum() * (1 << 20))))
    some = (rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).limit(2 * calibration_rows).select("statistics", "quality").collect())
    return calibrate(model, np.array([r[0] for r in some]), np.array([r[1] for r in some], float))


def score(described: DataFrame, model: Model, into: str = "score") -> DataFrame:
    """All columns of a frame with statistics, and the score."""
    kept = [f for f in described.schema if f.name != into]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("statistics").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*[b.column(f.name) for f in kept], pa.array(model.scores(x))], names=[*[f.name for f in kept], into])
    return described.mapInArrow(run, T.StructType([*kept, T.StructField(into, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted of each document."""
    described = stage(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics"), "qda-statistics")
    scored = score(described, learn(described, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
