import numpy as np
import pytest

from cohortwise.llm import quality_qda as qda
from cohortwise.llm.queries import QUERIES


def moments(x, y):
    return (np.array([(y == c).sum() for c in (0, 1)], float), np.array([x[y == c].sum(axis=0) for c in (0, 1)]), np.array([x[y == c].T @ x[y == c] for c in (0, 1)]))


def test_difference_is_that_of_normal_densities():
    rng = np.random.default_rng(0)
    y = (np.arange(600) % 3 > 0).astype(int)
    x = rng.normal(size=(600, 3)) @ np.array([[1, .4, 0], [0, 1, .2], [0, 0, 2]]) + y[:, None]
    model = qda.discriminant(*moments(x, y), pooled=0.0, identity=0.0)
    for c in (0, 1):
        own = x[y == c]
        cov = np.cov(own.T, bias=True)
        assert np.allclose(model.factors[c] @ model.factors[c].T, cov)
    log = []
    for c in (0, 1):
        own = x[y == c]
        cov, d = np.cov(own.T, bias=True), x - own.mean(axis=0)
        log.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d) - 0.5 * np.linalg.slogdet(cov)[1])
    assert np.allclose(model.difference(x), log[1] - log[0])


def test_shrinkage_makes_singular_covariances_usable():
    x = np.array([[0., 0.], [0., 0.], [1., 1.], [2., 2.], [3., 3.]])
    model = qda.discriminant(*moments(x, np.array([0, 0, 1, 1, 1])))
    assert np.isfinite(model.scores(x)).all()


def test_calibration_keeps_order_and_finds_shares():
    rng = np.random.default_rng(1)
    y = (rng.random(4000) < 0.8).astype(int)
    x = rng.normal(size=(4000, 2)) + 0.7 * y[:, None]
    model = qda.calibrate(qda.discriminant(*moments(x, y)), x, y.astype(float))
    s = model.scores(x)
    assert abs(s.mean() - y.mean()) < 0.01 and model.slope > 0
    high = s > 0.85
    assert abs(s[high].mean() - y[high].mean()) < 0.03


def test_classes_that_are_missing():
    x = np.zeros((4, 2))
    assert qda.discriminant(*moments(x, np.ones(4, int))).scores(x).tolist() == [1.0] * 4
    assert qda.discriminant(*moments(x, np.zeros(4, int))).scores(x).tolist() == [0.0] * 4
    assert qda.discriminant(np.zeros(2), np.zeros((2, 2)), np.zeros((2, 2, 2))).scores(x).tolist() == [0.5] * 4


@pytest.mark.parametrize("text", [None, "", " \n ", "a", "é" * 200_000, "word " * 100_000, "\x00\x01", "!!! ### |||"])
def test_statistics_of_odd_texts(text):
    got = qda.statistics(text.encode() if text is not None else None)
    assert len(got) == len(qda.STATISTICS) and np.isfinite(got).all()


def test_edges(spark, frame):
    docs = frame([(1, None), (1, None), (None, "text"), (3, "one more")])
    labels = spark.createDataFrame([(3, 1, 0), (3, 0, 0), (None, 1, 1), (9, None, 0)], "doc_id long, quality int, toxic int")
    got = qda.classify(docs.withColumnRenamed("source", "quality"), labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert qda.classify(frame([]), labels).collect() == []
    none = qda.classify(docs, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in QUERIES["op4_quadratic_discriminant"](spark, sf).collect() if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in got]) > 0.95
    bad = [r.score for r in got if truth[r.doc_id] == 0]
    good = [r.score for r in got if truth[r.doc_id] == 1]
    assert np.mean([b < g for b in bad for g in good]) > 0.97
