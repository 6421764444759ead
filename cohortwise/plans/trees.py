"""Classification trees with cost-complexity pruning, grown over grouped cells.

People are grouped into cells of equal features and fold. The tree of all people and those without one fold each grow together:
each level is one grouped aggregate of cells by tree, node, feature and value, from which running sums give every split's gain.
Only counts per node, at most 2^(depth + 1) a tree, come to the driver, where the weakest links are cut.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.plans import models

#: Places to which gains are compared.
PLACES = 9


@dataclass
class Tree:
    """Nodes by number (the root is 1, children 2i and 2i + 1) with people and cases, those of the held-out fold, and splits (feature, highest value to the left)."""

    counts: dict[int, tuple[float, float]] = field(default_factory=dict)
    held: dict[int, tuple[float, float]] = field(default_factory=dict)
    splits: dict[int, tuple[int, float]] = field(default_factory=dict)

    def risk(self, node: int) -> float:
        n, k = self.counts[node]
        return min(k, n - k) / self.counts[1][0]

    def predicts(self, node: int) -> int:
        n, k = self.counts[node]
        return int(2 * k > n)


def cells(df: DataFrame, label: Column, numeric: Sequence[str], categories: Mapping[str, Sequence[str]], key: str, folds: int) -> DataFrame:
    """(x, fold, n, k): equal features and fold together. Numbers take the median where missing; every listed level is a column of 0 and 1."""
    rows = with_features(df, numeric, categories)
    fold = (F.pmod(F.xxhash64(key), F.lit(folds)) + 1).cast("int")
    return rows.groupBy("x", fold.alias("fold")).agg(F.count("*").cast("double").alias("n"), F.sum(label.cast("int")).cast("double").alias("k"))


def with_features(df: DataFrame, numeric: Sequence[str], categories: Mapping[str, Sequence[str]]) -> DataFrame:
    numbers = []
    for c in numeric:
        df = models.impute_median(df.withColumn(f"_{c}", F.col(c).cast("double")), f"_{c}")
        numbers.append(F.coalesce(f"_{c}", F.lit(0.0)))
    dummies = [F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0)) for c, levels in categories.items() for v in levels]
    return df.withColumn("x", F.array(*numbers, *dummies)).drop(*[f"_{c}" for c in numeric])


def split_scores(rows: DataFrame, by: Sequence[str] = ("tree", "node")) -> DataFrame:
    """Every split of every node: feature, threshold, people and cases on the left, and the fall of the Gini impurity (summed over people).

    The histogram is per node, feature and value; running sums over the values give both sides.
    """
    keys = [*by, "feature"]
    hist = rows.select(*by, "n", "k", F.posexplode("x").alias("feature", "value")).groupBy(*keys, "value").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    order = Window.partitionBy(*keys).orderBy("value")
    run, all_ = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy(*keys)
    sides = hist.select(*keys, F.col("value").alias("threshold"), F.sum("n").over(run).alias("left_n"), F.sum("k").over(run).alias("left_k"),
                        F.sum("n").over(all_).alias("all_n"), F.sum("k").over(all_).alias("all_k"))
    impurity = lambda n, k: 2 * k * (n - k) / n
    n, k, right_n, right_k = F.col("left_n"), F.col("left_k"), F.col("all_n") - F.col("left_n"), F.col("all_k") - F.col("left_k")
    return sides.filter(right_n > 0).withColumn("gain", F.round(impurity(F.col("all_n"), F.col("all_k")) - impurity(n, k) - impurity(right_n, right_k), PLACES))


def grow(table: DataFrame, folds: int, depth: int = 6, least_split: int = 20, least_leaf: int = 7,
         stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> list[Tree]:
    """The tree of all cells, then one without each fold. Best gain wins, ties to the earlier feature and the lower threshold."""
    grown = [Tree() for _ in range(folds + 1)]
    tree = F.explode(F.sequence(F.lit(0), F.lit(folds))).alias("tree")
    rows = table.select("x", "n", "k", "fold", tree).select("tree", F.lit(1).alias("node"), (F.col("tree") == F.col("fold")).alias("out"), "x", "n", "k")
    for level in range(depth + 1):
        rows = stage(rows, "tree_rows_at_level")
        for r in rows.groupBy("tree", "node", "out").agg(F.sum("n").alias("n"), F.sum("k").alias("k")).collect():
            (grown[r.tree].held if r.out else grown[r.tree].counts)[r.node] = (r.n, r.k)
        if level == depth:
            break
        able = (F.col("all_n") >= least_split) & (F.col("left_n") >= least_leaf) & (F.col("all_n") - F.col("left_n") >= least_leaf) & (F.col("gain") > 0)
        best = split_scores(rows.filter(~F.col("out"))).filter(able).groupBy("tree", "node").agg(
            F.min(F.struct((-F.col("gain")).alias("g"), "feature", "threshold")).alias("b")).select("tree", "node", "b.feature", "b.threshold").collect()
        if not best:
            break
        for r in best:
            grown[r.tree].splits[r.node] = (r.feature, r.threshold)
        chosen = table.sparkSession.createDataFrame([tuple(r) for r in best], "tree int, node int, feature int, threshold double")
        right = (F.element_at("x", F.col("feature") + 1) > F.col("threshold")).cast("int")
        rows = rows.join(chosen, ["tree", "node"]).select("tree", (2 * F.col("node") + right).alias("node"), "out", "x", "n", "k")
    for t in grown:  # nodes that only the held-out fold reached have no counts of their own
        t.splits = {i: s for i, s in t.splits.items() if 2 * i in t.counts and 2 * i + 1 in t.counts}
    return grown


def weakest_links(tree: Tree) -> list[tuple[float, frozenset[int]]]:
    """Penalties and inner nodes of the nested best subtrees: each step cuts the nodes that save least risk per leaf."""
    inner = {i for i in tree.splits if i in tree.counts}
    inner = {i for i in inner if all(a in inner for a in _above(i))}

    def below(i: int) -> tuple[float, int]:
        if i not in inner:
            return tree.risk(i), 1
        (a, x), (b, y) = below(2 * i), below(2 * i + 1)
        return a + b, x + y

    def link(i: int) -> float:
        risk, leaves = below(i)
        return round((tree.risk(i) - risk) / (leaves - 1), 15)

    steps, penalty = [], 0.0
    while True:
        links = {i: link(i) for i in inner}
        weak = [i for i, g in links.items() if g <= penalty]
        if weak:
            inner = {i for i in inner if i not in weak and not any(a in weak for a in _above(i))}
            continue
        steps.append((penalty, frozenset(inner)))
        if not inner:
            return steps
        penalty = min(links.values())


def _above(i: int) -> list[int]:
    out = []
    while i > 1:
        i //= 2
        out.append(i)
    return out


def leaves(inner: frozenset[int]) -> list[int]:
    """Leaves of the subtree with these inner nodes."""
    return sorted([c for i in inner for c in (2 * i, 2 * i + 1) if c not in inner]) if inner else [1]


def at_penalty(steps: Sequence[tuple[float, frozenset[int]]], penalty: float) -> frozenset[int]:
    return [inner for alpha, inner in steps if alpha <= penalty][-1]


def chosen(grown: Sequence[Tree]) -> tuple[float, frozenset[int], list[tuple[float, int, float]]]:
    """Penalty and inner nodes of the whole tree with the least cross-validated error, ties to the smaller tree; and (penalty, leaves, error) of all.

    A penalty's error is that of the trees without a fold, cut at the geometric mean of this penalty and the next, on their folds.
    """
    steps = weakest_links(grown[0])
    without = [(t, weakest_links(t)) for t in grown[1:] if t.counts and t.held]
    table = []
    for i, (alpha, inner) in enumerate(steps):
        middle = math.sqrt(alpha * steps[i + 1][0]) if i + 1 < len(steps) else math.inf
        wrong = 0.0
        for t, own in without:
            for leaf in leaves(at_penalty(own, middle)):
                n, k = t.held.get(leaf, (0.0, 0.0))
                wrong += n - k if t.predicts(leaf) else k
        table.append((alpha, len(leaves(inner)), wrong / grown[0].counts[1][0]))
    best = max(range(len(table)), key=lambda i: (-round(table[i][2], 12), i))
    return steps[best][0], steps[best][1], table


def leaf_of(tree: Tree, inner: frozenset[int], node: int = 1) -> Column:
    """Number of the leaf that the features x of a row lead to."""
    if node not in inner:
        return F.lit(node)
    feature, threshold = tree.splits[node]
    return F.when(F.element_at("x", F.lit(feature + 1)) <= threshold, leaf_of(tree, inner, 2 * node)).otherwise(leaf_of(tree, inner, 2 * node + 1))


def rule_of(tree: Tree, node: int, names: Sequence[str]) -> str:
    """The conditions on the way to a node."""
    parts = []
    for a in sorted(_above(node)):
        feature, threshold = tree.splits[a]
        on_right = node >> (node.bit_length() - a.bit_length() - 1) & 1
        parts.append(f"{names[feature]} {'>' if on_right else '<='} {threshold:g}")
    return " and ".join(parts)


@dataclass
class Pruned:
    tree: Tree
    inner: frozenset[int]
    names: list[str]
    table: list[tuple[float, int, float]]


def pruned_tree(df: DataFrame, label: Column, numeric: Sequence[str], categories: Mapping[str, Sequence[str]], key: str, folds: int = 10,
                stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df, **how) -> Pruned:
    table = stage(cells(df, label, numeric, categories, key, folds), "tree_cells")
    grown = grow(table, folds, stage=stage, **how)
    if not grown[0].counts:
        grown[0].counts[1] = (0.0, 0.0)
        return Pruned(grown[0], frozenset(), [], [])
    _, inner, errors = chosen(grown)
    return Pruned(grown[0], inner, [*numeric, *[f"{c} is {v}" for c, levels in categories.items() for v in levels]], errors)


def leaf_table(df: DataFrame, label: Column, model: Pruned, numeric: Sequence[str], categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row per leaf: its rule, people, cases and prediction, counted by sending all rows down the tree."""
    rows = with_features(df, numeric, categories).groupBy(leaf_of(model.tree, model.inner).alias("leaf")).agg(
        F.count("*").alias("people"), F.sum(label.cast("int")).alias("cases"))
    told = [(leaf, rule_of(model.tree, leaf, model.names), model.tree.predicts(leaf)) for leaf in leaves(model.inner)]
    return rows.join(df.sparkSession.createDataFrame(told, "leaf int, rule string, prediction int"), "leaf").select("leaf", "rule", "people", "cases", "prediction")


def predictions(df: DataFrame, label: Column, model: Pruned, numeric: Sequence[str], categories: Mapping[str, Sequence[str]], key: str) -> DataFrame:
    ones = [leaf for leaf in leaves(model.inner) if model.tree.predicts(leaf)]
    leaf = leaf_of(model.tree, model.inner)
    return with_features(df, numeric, categories).select(key, label.cast("int").alias("label"), leaf.alias("leaf"), leaf.isin(ones).cast("int").alias("prediction"))
