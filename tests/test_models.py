import math
import random
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortwise.plans import regression, trees

LEVELS = {"a": ["x", "y", "z"], "b": ["p", "q"]}


@pytest.fixture(scope="module")
def people():
    rng, rows = random.Random(8), []
    for a, b in product(["x", "y", "z", "other", None], ["p", "q"]):
        for _ in range(rng.randint(40, 90)):
            eta = -0.4 + {"y": 0.8, "z": -0.5}.get(a, 0) + (0.6 if b == "q" else 0)
            rows.append((a, b, rng.random() < 1 / (1 + math.exp(-eta))))
    return rows


def design(rows):
    used = [r for r in rows if r[0] in LEVELS["a"]]
    x = np.array([[1, a == "y", a == "z", b == "q"] for a, b, _ in used], float)
    return x, np.array([k for *_, k in used], float)


def newton(x, y, fixed=None):
    """Plain fit over people; fixed = (column, value) holds a coefficient."""
    beta = np.zeros(x.shape[1])
    free = np.ones(len(beta), bool)
    if fixed:
        beta[fixed[0]], free[fixed[0]] = fixed[1], False
    for _ in range(40):
        p = 1 / (1 + np.exp(-x @ beta))
        beta[free] += np.linalg.solve((x[:, free].T * (p * (1 - p))) @ x[:, free], x[:, free].T @ (y - p))
    p = 1 / (1 + np.exp(-x @ beta))
    return beta, float((y * np.log(p) + (1 - y) * np.log(1 - p)).sum())


def fitted(spark, people):
    df = spark.createDataFrame([(*r, 1) for r in people], "a string, b string, k boolean, w int")
    return regression.fit(df.groupBy("a", "b", "k").agg(F.sum("w").alias("w")), F.col("k"), LEVELS, "w")


def test_joint_fit_equals_newton_over_people(spark, people):
    model, (beta, value) = fitted(spark, people), newton(*design(people))
    assert model.terms == [("", "intercept"), ("a", "y"), ("a", "z"), ("b", "q")]
    assert np.allclose(model.beta, beta, atol=1e-7) and abs(model.log_likelihood - value) < 1e-6
    for r in regression.level_counts(regression.scored(model), ["a", "b"]).collect():
        assert abs(r.expected - r.cases) < 1e-5


def test_interval_ends_equal_a_grid_search(spark, people):
    model, (x, y) = fitted(spark, people), design(people)
    ends, target = regression.likelihood_intervals(model), model.log_likelihood - regression.CHI2_95 / 2
    for j in range(1, 4):
        for end, sign in zip(ends[j], (-1, 1)):
            step, best = 0.25, model.beta[j]
            while step > 1e-5:  # the last grid point above the target, on ever finer grids
                while newton(x, y, (j, best + sign * step))[1] >= target:
                    best += sign * step
                step /= 5
            assert abs(end - best) < 1e-4
    table = {(r.factor, r.level): r for r in regression.odds_table(model).collect()}
    assert table["a", "x"].is_base and table["a", "x"].odds_ratio is None
    assert abs(table["b", "q"].lower - math.exp(ends[3][0])) < 1e-3


def test_levels_without_cases_stay_out(spark):
    rows = [("x", "p", True, 5), ("x", "p", False, 9), ("x", "q", True, 4), ("x", "q", False, 3), ("y", "p", False, 7), ("z", "q", True, 2), ("z", "p", True, 2)]
    model = regression.fit(spark.createDataFrame(rows, "a string, b string, k boolean, w int"), F.col("k"), LEVELS, "w")
    assert sorted(model.left_out) == [("a", "y"), ("a", "z")] and model.terms == [("", "intercept"), ("b", "q")]
    assert abs(model.beta[1] - math.log(4 * 9 / (3 * 5))) < 1e-8


def test_measures_equal_those_over_people(spark, people):
    given = {("", "intercept"): -0.3, ("a", "y"): 0.7, ("a", "z"): -0.4, ("b", "q"): 0.5}
    df = spark.createDataFrame(people, "a string, b string, k boolean").withColumn("w", F.lit(1))
    got = regression.fit_measures(regression.with_score(regression.grouped(df, F.col("k"), LEVELS, "w"), given), 4).first()
    x, y = design(people)
    s = np.round(1 / (1 + np.exp(-x @ np.array(list(given.values())))), 12)
    diff = s[y == 1][:, None] - s[y == 0][None]
    assert (got.people, got.cases) == (len(y), int(y.sum()))
    assert abs(got.concordance - ((diff > 0).sum() + (diff == 0).sum() / 2) / diff.size) < 1e-6
    assert abs(got.aic - (8 - 2 * (y * np.log(s) + (1 - y) * np.log(1 - s)).sum())) < 1e-3
    ends = np.unique(np.round(np.quantile(s, np.arange(11) / 10), 12))
    group = np.maximum(np.searchsorted(ends, s, "left"), 1)
    chi = 0.0
    for g in set(group.tolist()):
        n, k, e = (group == g).sum(), y[group == g].sum(), s[group == g].sum()
        chi += (k - e) ** 2 / e + (k - e) ** 2 / (n - e)
    assert abs(got.hl_chi_square - chi) < 1e-3
    assert abs(got.hl_p - math.exp(-chi / 2) * sum((chi / 2) ** i / math.factorial(i) for i in range(4))) < 1e-5


# --- trees

def impurity(rows):
    n, k = len(rows), sum(y for _, y in rows)
    return 2 * k * (n - k) / n


def brute_grow(rows, depth, node=1, out=None):
    """Splits and counts of a tree over people, one node after the other."""
    out = {"counts": {}, "splits": {}} if out is None else out
    out["counts"][node] = (len(rows), sum(y for _, y in rows))
    if node < 1 << depth and len(rows) >= 20:
        found = []
        for f in range(len(rows[0][0])):
            for t in sorted({x[f] for x, _ in rows})[:-1]:
                left, right = [r for r in rows if r[0][f] <= t], [r for r in rows if r[0][f] > t]
                gain = round(impurity(rows) - impurity(left) - impurity(right), trees.PLACES)
                if min(len(left), len(right)) >= 7 and gain > 0:
                    found.append((-gain, f, t, left, right))
        if found:
            _, f, t, left, right = min(found, key=lambda s: s[:3])
            out["splits"][node] = (f, t)
            brute_grow(left, depth, 2 * node, out)
            brute_grow(right, depth, 2 * node + 1, out)
    return out


def brute_best(tree, penalty):
    """The smallest of the subtrees with the least risk plus penalty per leaf, by trying both choices at each node."""
    total = tree["counts"][1][0]

    def best(i):
        n, k = tree["counts"][i]
        leaf = (min(k, n - k) / total + penalty, frozenset())
        if i not in tree["splits"]:
            return leaf
        (a, x), (b, y) = best(2 * i), best(2 * i + 1)
        return leaf if leaf[0] <= a + b + 1e-12 else (a + b, x | y | {i})
    return best(1)[1]


@pytest.fixture(scope="module")
def cases():
    rng, rows = random.Random(21), []
    for i in range(700):
        age, sex, town = rng.randint(50, 80), rng.randint(0, 1), rng.randint(0, 1)
        rows.append((f"p{i}", age, ["F", "M"][sex], ["R", "U"][town], rng.random() < (0.75 if age > 68 and sex else 0.2 + 0.3 * town)))
    return rows


SORTS = {"sex": ["M"], "town": ["U"]}


def test_growth_links_and_choice_equal_brute_force(spark, cases):
    df = spark.createDataFrame(cases, "key string, age int, sex string, town string, hit boolean")
    table = trees.cells(df, F.col("hit"), ["age"], SORTS, "key", 5)
    folds = {r.key: r.fold for r in df.select("key", (F.pmod(F.xxhash64("key"), F.lit(5)) + 1).cast("int").alias("fold")).collect()}
    grown = trees.grow(table, 5, depth=4)
    people = [(k, (float(a), float(s == "M"), float(t == "U")), int(h)) for k, a, s, t, h in cases]
    brute = [brute_grow([(x, y) for k, x, y in people if folds[k] != v], 4) for v in range(6)]
    for t, b in zip(grown, brute):
        assert t.splits == b["splits"] and t.counts == b["counts"]

    steps = trees.weakest_links(grown[0])
    assert len(steps) > 2 and not steps[-1][1]
    for i, (alpha, inner) in enumerate(steps):
        above = steps[i + 1][0] if i + 1 < len(steps) else alpha + 1
        assert inner == brute_best(brute[0], (alpha + above) / 2)

    def leaf(tree, inner, x):
        i = 1
        while i in inner:
            f, t = tree["splits"][i]
            i = 2 * i + (x[f] > t)
        return i
    errors = []
    for i, (alpha, _) in enumerate(steps):
        middle = math.sqrt(alpha * steps[i + 1][0]) if i + 1 < len(steps) else 1e9
        wrong = 0
        for v in range(1, 6):
            inner = brute_best(brute[v], middle)
            for k, x, y in people:
                if folds[k] == v:
                    n, c = brute[v]["counts"][leaf(brute[v], inner, x)]
                    wrong += y != (2 * c > n)
        errors.append(wrong)
    penalty, inner, told = trees.chosen(grown)
    assert [round(e * len(cases)) for *_, e in told] == errors
    best = max(i for i, e in enumerate(errors) if e == min(errors))
    assert (penalty, inner) == steps[best] and inner

    model = trees.pruned_tree(df, F.col("hit"), ["age"], SORTS, "key", 5, depth=4)
    assert model.inner == inner
    rows = {r.leaf: (r.people, r.cases, r.prediction) for r in trees.leaf_table(df, F.col("hit"), model, ["age"], SORTS).collect()}
    assert rows == {i: (*brute[0]["counts"][i], int(2 * brute[0]["counts"][i][1] > brute[0]["counts"][i][0])) for i in trees.leaves(inner)}
    said = {r.key: r.prediction for r in trees.predictions(df, F.col("hit"), model, ["age"], SORTS, "key").collect()}
    assert all(said[k] == rows[leaf(brute[0], inner, x)][2] for k, x, _ in people)


def test_rules_of_leaves_and_no_rows(spark, cases):
    t = trees.Tree({1: (10, 4), 2: (6, 1), 3: (4, 3), 6: (2, 2), 7: (2, 1)}, {}, {1: (0, 60.0), 3: (1, 0.0)})
    assert trees.rule_of(t, 7, ["age", "sex is M"]) == "age > 60 and sex is M > 0" and trees.rule_of(t, 2, ["age", "x"]) == "age <= 60"
    assert trees.leaves(frozenset({1, 3})) == [2, 6, 7] and trees.leaves(frozenset()) == [1]
    none = spark.createDataFrame([], "key string, age int, sex string, town string, hit boolean")
    assert trees.pruned_tree(none, F.col("hit"), ["age"], SORTS, "key", 3).inner == frozenset()
