"""Odds ratios and a decision tree over person level milestones."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def odds_ratio_2x2(df: DataFrame, exposed: Column, case: Column, weight: str) -> DataFrame:
    """Odds ratio of one two-level factor with its 95% interval, in closed form."""
    cell = lambda e, c: F.sum(F.when(e & c, F.col(weight))).cast("double")
    cells = df.agg(cell(exposed, case).alias("a"), cell(exposed, ~case).alias("b"),
                   cell(~exposed, case).alias("c"), cell(~exposed, ~case).alias("d"))
    log_or = F.log(F.col("a") * F.col("d") / (F.col("b") * F.col("c")))
    se = F.sqrt(1 / F.col("a") + 1 / F.col("b") + 1 / F.col("c") + 1 / F.col("d"))
    return cells.select("a", "b", "c", "d", F.round(F.exp(log_or), 4).alias("odds_ratio"),
                        F.round(F.exp(log_or - 1.96 * se), 4).alias("lower"),
                        F.round(F.exp(log_or + 1.96 * se), 4).alias("upper"))


def odds_by_level(df: DataFrame, case: Column, references: Mapping[str, str], weight: str) -> DataFrame:
    """Odds ratio of each level of each factor against the factor's reference level, with cases and others, in closed form.

    One grouped pass serves all factors; a missing level is no level.
    """
    cells = F.array(*[F.struct(F.lit(f).alias("factor"), F.col(f).cast("string").alias("level"), F.lit(r).alias("reference")) for f, r in references.items()])
    counts = (df.select(case.alias("_case"), F.col(weight).alias("_w"), F.explode(cells).alias("_c")).filter("_c.level IS NOT NULL")
              .groupBy("_c.factor", "_c.level", "_c.reference")
              .agg(F.coalesce(F.sum(F.when(F.col("_case"), F.col("_w"))), F.lit(0)).cast("double").alias("cases"),
                   F.coalesce(F.sum(F.when(~F.coalesce("_case", F.lit(False)), F.col("_w"))), F.lit(0)).cast("double").alias("others")))
    base = counts.filter("level = reference").select("factor", F.col("cases").alias("_c"), F.col("others").alias("_d"))
    part = lambda c: F.nullif(F.col(c), F.lit(0.0))  # no ratio where a cell is empty
    log_or = F.log(part("cases") * part("_d") / (part("others") * part("_c")))
    se = F.sqrt(1 / part("cases") + 1 / part("others") + 1 / part("_c") + 1 / part("_d"))
    return counts.join(base, "factor", "left").select(
        "factor", "level", "reference", "cases", "others", F.round(F.exp(log_or), 4).alias("odds_ratio"),
        F.round(F.exp(log_or - 1.96 * se), 4).alias("lower"), F.round(F.exp(log_or + 1.96 * se), 4).alias("upper"))


def odds_ratio_model(df: DataFrame, case: Column, factors: Sequence[str], weight: str) -> DataFrame:
    """Logistic regression on the pre-aggregated cells, one row per factor level.

    A cell is a combination of factor levels with its share of cases and its number of
    people as weight, so the fit runs over combinations, not people. The first level by
    name is the reference level. Only coefficients reach the driver.
    """
    cells = (df.dropna(subset=list(factors)).groupBy(*factors)
             .agg(F.sum(weight).cast("double").alias("w"), F.sum(F.when(case, F.col(weight)).otherwise(0)).cast("double").alias("_k"))
             .withColumn("label", F.col("_k") / F.col("w")))
    idx = [StringIndexer(inputCol=f, outputCol=f"{f}_i", stringOrderType="alphabetDesc") for f in factors]
    hot = OneHotEncoder(inputCols=[f"{f}_i" for f in factors], outputCols=[f"{f}_v" for f in factors], dropLast=True)
    vec = VectorAssembler(inputCols=[f"{f}_v" for f in factors], outputCol="features")
    glm = GeneralizedLinearRegression(family="binomial", link="logit", weightCol="w", maxIter=50)
    model = Pipeline(stages=[*idx, hot, vec, glm]).fit(cells)
    names = [f"{f}={lab}" for f, m in zip(factors, model.stages) for lab in m.labels[:-1]]
    fit = model.stages[-1]
    errors = fit.summary.coefficientStandardErrors
    rows = [(n, float(b), float(e)) for n, b, e in zip(names, fit.coefficients, errors)]
    out = df.sparkSession.createDataFrame(rows, "term string, coefficient double, std_error double")
    b, e = F.col("coefficient"), F.col("std_error")
    return out.select("term", F.round(F.exp(b), 4).alias("odds_ratio"),
                      F.round(F.exp(b - 1.96 * e), 4).alias("lower"), F.round(F.exp(b + 1.96 * e), 4).alias("upper"))


def impute_median(df: DataFrame, column: str) -> DataFrame:
    """Missing values take the exact median, a scalar subquery."""
    return df.withColumn(column, F.coalesce(F.col(column), df.select(F.median(column)).scalar()))


def fit_tree(df: DataFrame, label: Column, numeric: Sequence[str], categories: Sequence[str], depths=(2, 4, 6),
             min_gain=(0.0, 0.001), folds: int = 2, seed: int = 7, stage: Callable[[DataFrame, str], DataFrame] = lambda df, name: df):
    """Tree over numbers (missing ones take the exact median) and dummy columns; depth and least gain by cross-validation.

    Each fit reads the prepared features again; stage writes them once (see io.staged).
    Spark trees have no cost-complexity pruning; the cross-validated limits stand for it.
    """
    data = df.withColumn("label", label.cast("double"))
    imputed = [f"{c}_m" for c in numeric]
    for c, m in zip(numeric, imputed):
        data = impute_median(data.withColumn(m, F.col(c).cast("double")), m)
    stages = [
        StringIndexer(inputCols=list(categories), outputCols=[f"{c}_i" for c in categories], handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{c}_i" for c in categories], outputCols=[f"{c}_v" for c in categories]),
        VectorAssembler(inputCols=[*imputed, *[f"{c}_v" for c in categories]], outputCol="features"),
    ]
    prepared = Pipeline(stages=stages).fit(data).transform(data).select("features", "label", *df.columns)
    prepared = stage(prepared, "tree_features")
    tree = DecisionTreeClassifier(seed=seed)
    grid = ParamGridBuilder().addGrid(tree.maxDepth, list(depths)).addGrid(tree.minInfoGain, list(min_gain)).build()
    cv = CrossValidator(estimator=tree, estimatorParamMaps=grid, numFolds=folds, seed=seed,
                        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"))
    return cv.fit(prepared), prepared


def tree_predictions(df: DataFrame, label: Column, numeric: Sequence[str], categories: Sequence[str], key: str, **how) -> DataFrame:
    model, prepared = fit_tree(df, label, numeric, categories, **how)
    return model.transform(prepared).select(key, F.col("label").cast("int").alias("label"),
                                            F.col("prediction").cast("int").alias("prediction"))
