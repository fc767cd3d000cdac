"""Fitting on Spark: pipelines, temporal folds, search, ensembles and importances."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from operator import add
from random import Random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.features import frequency_encode
from tidemark.operators.compiled import logistic_probability
from tidemark.operators.metrics import ranking_metrics, ranking_of_counts
from tidemark.sources.io import written


def prepare(df: DataFrame, label: str, categorical: list[str], fit_on: Column) -> DataFrame:
    """Labelled rows with frequency-encoded categories and balanced weights, both learned on ``fit_on``."""
    for c in categorical:
        df = frequency_encode(df, c, fit_on)
    share = df.where(fit_on & F.col(label).isin(0, 1)).agg(F.avg(F.col(label).cast("double")).alias("p")).first()["p"] or 0.5
    share = min(max(share, 1e-6), 1 - 1e-6)
    return df.withColumns({"_label": F.col(label).cast("double"), "_weight": F.when(F.col(label) == 1, 0.5 / share).otherwise(0.5 / (1 - share))})


def _inputs(features: list[str]) -> list:
    filled = [f"_f_{c}" for c in features]
    return [Imputer(inputCols=features, outputCols=filled, strategy="median"), VectorAssembler(inputCols=filled, outputCol="_x")]


def lasso_pipeline(features: list[str], penalty: float = 0.001, tolerance: float = 1e-6) -> Pipeline:
    return Pipeline(stages=[*_inputs(features), StandardScaler(inputCol="_x", outputCol="_z", withMean=True), LogisticRegression(
        featuresCol="_z", labelCol="_label", weightCol="_weight", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100, tol=tolerance)])


#: How often trees of one fit write their rows' nodes, so that their lineage stays short.
CHECKPOINT = 10


def boosted_pipeline(features: list[str], rounds: int = 20, depth: int = 4, step: float = 0.1, seed: int = 42, validation: str | None = None) -> Pipeline:
    """Boosted trees; with a boolean column ``validation`` they stop once its rows' error no longer falls."""
    trees = GBTClassifier(
        featuresCol="_x", labelCol="_label", weightCol="_weight", maxIter=rounds, maxDepth=depth, stepSize=step, subsamplingRate=0.8, seed=seed,
        cacheNodeIds=True, checkpointInterval=CHECKPOINT, validationTol=0.0)
    return Pipeline(stages=[*_inputs(features), trees.setValidationIndicatorCol(validation) if validation else trees])


def forest_pipeline(features: list[str], trees: int = 500, depth: int = 12, least: int = 50, seed: int = 42) -> Pipeline:
    """A forest; rows keep the numbers of their nodes from level to level, and many nodes are split in one pass."""
    return Pipeline(stages=[*_inputs(features), RandomForestClassifier(
        featuresCol="_x", labelCol="_label", weightCol="_weight", numTrees=trees, maxDepth=depth, minInstancesPerNode=least, seed=seed,
        cacheNodeIds=True, checkpointInterval=CHECKPOINT, maxMemoryInMB=1024)])


def predict(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    """``df`` with the probability of label 1: an expression over the columns for logistic models, else by the model."""
    p = logistic_probability(model)
    if p is not None:
        return df.withColumn(name, p)
    out = model.transform(df).withColumn(name, vector_to_array(F.col("probability"))[1])
    return out.select(*df.columns, name)


@dataclass(frozen=True)
class Fold:
    train: list[int]
    test: list[int]


def expanding_folds(snapshots: list[int], least: int = 2) -> list[Fold]:
    """Each later snapshot tested on all before it."""
    s = sorted(snapshots)
    return [Fold(s[:i], [s[i]]) for i in range(least, len(s))]


def cross_validate(pipeline: Pipeline, df: DataFrame, label: str, snapshot: str, folds: list[Fold]) -> DataFrame:
    """KS, AUC and Gini on each fold's test snapshots."""
    out = None
    for i, f in enumerate(folds):
        model = pipeline.fit(df.where(F.col(snapshot).isin(f.train) & F.col(label).isin(0, 1)))
        m = ranking_metrics(predict(model, df.where(F.col(snapshot).isin(f.test)), "p"), label, "p").withColumn("fold", F.lit(i))
        out = m if out is None else out.unionByName(m)
    return out


def random_search(build, grid: dict[str, list], n: int, df: DataFrame, label: str, snapshot: str, folds: list[Fold], seed: int = 42) -> DataFrame:
    """Mean KS over folds of ``n`` settings drawn from a grid, best first."""
    settings = [dict(zip(grid, v)) for v in product(*grid.values())]
    chosen = Random(seed).sample(settings, min(n, len(settings)))
    out = None
    for s in chosen:
        m = cross_validate(build(**s), df, label, snapshot, folds).agg(F.avg("ks").alias("ks"), F.avg("auc").alias("auc")).withColumn("setting", F.lit(str(s)))
        out = m if out is None else out.unionByName(m)
    return out.orderBy(F.desc("ks"), "setting")


def average(columns: list[str]) -> Column:
    total = F.lit(0.0)
    for c in columns:
        total = total + F.col(c)
    return total / len(columns)


def simplex(n: int, steps: int, least: float = 0.01) -> list[list[float]]:
    """Weights that add up to 1 on a grid, none below ``least``."""
    out = [[i / steps for i in p] for p in product(range(steps + 1), repeat=n) if sum(p) == steps]
    return [w for w in out if min(w) >= least]


def blend_weights(df: DataFrame, label: str, columns: list[str], steps: int = 10, least: float = 0.01) -> DataFrame:
    """KS and AUC of every weighting of the prediction columns, all in one pass, best first.

    KS is piecewise constant in the weights, so a grid finds what a gradient can't.
    Rows are counted by their predictions first, and only these counts are taken once
    for every weighting.
    """
    grid = simplex(len(columns), steps, least)
    ps = [f"_p{i}" for i in range(len(columns))]
    counted = written(df.where(F.col(label).isin(0, 1)).groupBy(*(F.col(c).cast("double").alias(p) for c, p in zip(columns, ps))).agg(
        F.count_if(F.col(label) == 1).alias("bad"), F.count_if(F.col(label) == 0).alias("good")))
    weights = F.array(*(F.struct(F.lit(i).alias("setting"), F.array(*map(F.lit, w)).alias("w")) for i, w in enumerate(grid)))
    mixed = reduce(add, (F.col(p) * F.col("_s.w")[i] for i, p in enumerate(ps)), F.lit(0.0))
    rows = counted.select(*ps, "bad", "good", F.explode(weights).alias("_s")).select(F.col("_s.setting").alias("setting"), F.round(mixed, 9).alias("score"), "bad", "good")
    rows = rows.where(F.col("score").isNotNull() & ~F.isnan("score"))
    m = ranking_of_counts(rows.groupBy("setting", "score").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")), ["setting"])
    names = df.sparkSession.createDataFrame([(i, w) for i, w in enumerate(grid)], "setting int, weights array<double>")
    return m.join(F.broadcast(names), "setting").orderBy(F.desc("ks"), "setting")


def out_of_fold(pipelines: dict[str, Pipeline], df: DataFrame, label: str, snapshot: str, folds: list[Fold]) -> DataFrame:
    """Rows of the folds' test snapshots with predictions of models that didn't see them."""
    out = None
    for f in folds:
        part = df.where(F.col(snapshot).isin(f.test))
        for name, p in pipelines.items():
            part = predict(p.fit(df.where(F.col(snapshot).isin(f.train) & F.col(label).isin(0, 1))), part, name)
        out = part if out is None else out.unionByName(part)
    return out


def stack(df: DataFrame, label: str, columns: list[str]) -> PipelineModel:
    """A logistic meta-learner over prediction columns."""
    rows = df.where(F.col(label).isin(0, 1)).withColumn("_label", F.col(label).cast("double"))
    return Pipeline(stages=[VectorAssembler(inputCols=columns, outputCol="_m"), LogisticRegression(featuresCol="_m", labelCol="_label", regParam=0.001)]).fit(rows)


def champion(metrics: DataFrame) -> DataFrame:
    """The model to take: those that pass the gate first, then by KS."""
    return metrics.orderBy(F.desc("passed"), F.desc("ks"), "model").limit(1)


def importances(model: PipelineModel, features: list[str], df: DataFrame, groups: dict[str, str] | None = None) -> DataFrame:
    """Feature importances with shares, and the share of each feature's group."""
    last = model.stages[-1]
    values = last.featureImportances.toArray() if hasattr(last, "featureImportances") else abs(last.coefficients.toArray())
    total = float(sum(values)) or 1.0
    rows = [(f, float(v), float(v) / total, (groups or {}).get(f, f.split("_")[0])) for f, v in zip(features, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, share double, feature_group string").orderBy(F.desc("importance"), "feature")


def odds_ratios(model: PipelineModel, features: list[str], df: DataFrame) -> DataFrame:
    rows = [(f, float(c)) for f, c in zip(features, model.stages[-1].coefficients.toArray())]
    return df.sparkSession.createDataFrame(rows, "feature string, coefficient double").withColumn("odds_ratio", F.exp("coefficient"))


def incremental_ks(df: DataFrame, label: str, groups: dict[str, list[str]], train: Column, test: Column) -> DataFrame:
    """KS on the test rows as feature groups are added one after the other."""
    out, features = None, []
    for i, (name, columns) in enumerate(groups.items()):
        features = features + columns
        model = lasso_pipeline(features).fit(df.where(train & F.col(label).isin(0, 1)))
        m = ranking_metrics(predict(model, df.where(test), "p"), label, "p").withColumns({"step": F.lit(i), "added": F.lit(name), "n_features": F.lit(len(features))})
        out = m if out is None else out.unionByName(m)
    return out


def permuted(df: DataFrame, features: list[str], key: str, by: list[str] | None = None, seed: int = 7, bucket_rows: int = 50_000) -> DataFrame:
    """``df`` with a column ``_to_<feature>`` for each feature: its values dealt to other rows of the group.

    Within buckets of about ``bucket_rows`` rows, a feature's values move on by one
    along a random order of its own, the last one's to the first row. All features
    share one shuffle, and no task holds more than a bucket.
    """
    by = by or []
    buckets = max(df.count() // bucket_rows, 1)
    within = Window.partitionBy(*by, "_b")
    rows = df.withColumn("_b", F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(buckets)))
    dealt = {}
    for f in features:
        along = within.orderBy(F.xxhash64(key, F.lit(f"{f}{seed}")), key)
        # structs, as a value may itself be null
        value = F.struct(F.col(f).alias("v"))
        dealt[f"_to_{f}"] = F.coalesce(F.lag(value).over(along), F.last(value).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))["v"]
    return rows.withColumns(dealt).drop("_b")


def permutation_importance(model: PipelineModel, df: DataFrame, label: str, features: list[str], key: str, by: list[str] | None = None, seed: int = 7) -> DataFrame:
    """AUC lost when a feature is shuffled, by group.

    Every row is scored as it is and once for each feature with another row's
    value; the model and the ranking see all of them together.
    """
    by = by or []
    rows = permuted(df, features, key, by, seed)
    inputs = [c for c in df.columns if c not in {label, *by}]

    def version(name: str | None) -> Column:
        return F.struct(F.lit(name or "").alias("feature"), *(F.col(f"_to_{c}" if c == name else c).alias(c) for c in inputs))

    versions = F.explode(F.array(version(None), *map(version, features)))
    every = rows.select(label, *by, versions.alias("_v")).select(label, *by, F.col("_v.feature").alias("_feature"), *(F.col(f"_v.{c}").alias(c) for c in inputs))
    m = ranking_metrics(predict(model, every, "_p"), label, "_p", [*by, "_feature"]).select(*by, "_feature", "auc")
    base = m.where("_feature = ''").select(*by, F.col("auc").alias("auc_base"))
    shuffled = m.where("_feature <> ''").select(*by, F.col("auc").alias("auc_shuffled"), F.col("_feature").alias("feature"))
    joined = shuffled.join(base, by) if by else shuffled.join(F.broadcast(base))  # a row
    return joined.withColumn("drop", F.col("auc_base") - F.col("auc_shuffled"))
