"""Feature selection: information value, lasso, correlation, stability, leakage."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.clean import LEAKAGE, impute_median, inf_to_null
from tidemark.operators.binning import information_value, psi_table
from tidemark.operators.sampling import exact_sample


def iv_filter(df: DataFrame, columns: list[str], label: str, least: float = 0.02) -> DataFrame:
    """Features with their IV, rank, strength and whether they stay."""
    iv = information_value(df, columns, label)
    w = Window.orderBy(F.desc("iv"), "feature")  # a row for each feature
    return iv.withColumns({"rank": F.row_number().over(w), "kept": F.col("iv") > least})


def _assembled(df: DataFrame, columns: list[str], label: str | None = None) -> DataFrame:
    filled = df.select(*([F.col(label).cast("double").alias("label")] if label else []), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns))
    return VectorAssembler(inputCols=columns, outputCol="x").transform(filled)


def lasso_filter(df: DataFrame, columns: list[str], label: str, penalty: float = 0.001) -> DataFrame:
    """Standardised lasso logistic regression on all labelled rows, classes balanced: (feature, coefficient, kept)."""
    rows = impute_median(inf_to_null(df.where(F.col(label).isin(0, 1)), columns), columns, F.lit(True))
    rows = _assembled(rows, columns, label)
    share = rows.agg(F.avg("label").alias("p")).first()["p"]
    weighted = rows.withColumn("w", F.when(F.col("label") == 1, 0.5 / share).otherwise(0.5 / (1 - share)))
    scaled = StandardScaler(inputCol="x", outputCol="z", withMean=True).fit(weighted).transform(weighted)
    model = LogisticRegression(featuresCol="z", labelCol="label", weightCol="w", elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=100).fit(scaled)
    found = [(c, float(w), bool(abs(w) > 0)) for c, w in zip(columns, model.coefficients.toArray())]
    return df.sparkSession.createDataFrame(found, "feature string, coefficient double, kept boolean")


def correlation_matrix(df: DataFrame, columns: list[str]) -> np.ndarray:
    """Pearson correlations, nulls as 0; a constant column has none with others (0)."""
    m = Correlation.corr(_assembled(df, columns), "x").first()[0].toArray()
    return np.nan_to_num(m)


def correlation_pairs(df: DataFrame, columns: list[str], limit: float = 0.80) -> DataFrame:
    """(a, b, correlation, strength, high) of each pair of columns."""
    m = correlation_matrix(df, columns)
    rows = [(a, b, float(m[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j]
    r = F.abs("correlation")
    kind = F.when(r >= 0.9, "very strong").when(r >= 0.7, "strong").when(r >= 0.5, "moderate").when(r >= 0.3, "weak").otherwise("none")
    return df.sparkSession.createDataFrame(rows, "a string, b string, correlation double").withColumns({"strength": kind, "high": r > limit})


def correlation_filter(df: DataFrame, columns: list[str], iv: dict[str, float], keep: list[str] | None = None, limit: float = 0.90) -> list[str]:
    """Greedy over the matrix: of a pair above the limit a kept-list feature stays, else that of higher IV, ties the first."""
    m, gone, safe = np.abs(correlation_matrix(df, columns)), set(), set(keep or [])
    for i, a in enumerate(columns):
        for j in range(i + 1, len(columns)):
            b = columns[j]
            if a in gone or b in gone or m[i, j] <= limit:
                continue
            loser = b if (a in safe) > (b in safe) else a if (b in safe) > (a in safe) else b if iv.get(a, 0) >= iv.get(b, 0) else a
            gone.add(loser)
    return [c for c in columns if c not in gone]


def drop_most_correlated(df: DataFrame, columns: list[str], limit: float = 0.8) -> list[str]:
    """Drop the column with the greatest correlation until none is at or above the limit; of two, that of less variance."""
    m = np.abs(correlation_matrix(df, columns))
    np.fill_diagonal(m, 0)
    row = df.agg(*(F.var_samp(F.col(c).cast("double")).alias(c) for c in columns)).first()
    left = list(range(len(columns)))
    while len(left) > 1:
        part = m[np.ix_(left, left)]
        i, j = np.unravel_index(part.argmax(), part.shape)
        if part[i, j] < limit:
            break
        a, b = left[i], left[j]
        left.remove(a if (row[columns[a]] or 0) < (row[columns[b]] or 0) else b)
    return [columns[i] for i in left]


def stability_filter(df: DataFrame, columns: list[str], expected: Column, actual: Column, limit: float = 0.25) -> DataFrame:
    return psi_table(df, columns, expected, actual).withColumn("kept", F.col("psi") < limit)


def snapshot_stability(df: DataFrame, columns: list[str], snapshot: str, first: object, limit: float = 0.20, min_rows: int = 100) -> DataFrame:
    """Each snapshot against the first one: unstable features are above the limit anywhere."""
    base = F.col(snapshot) == first
    p = psi_table(df, columns, base, ~base, [snapshot], min_rows=min_rows)
    return p.groupBy("feature").agg(F.max("psi").alias("max_psi"), F.count_if(F.col("psi") > limit).alias("n_unstable")).withColumn("stable", F.col("n_unstable") == 0)


def label_correlations(df: DataFrame, columns: list[str], label: str) -> DataFrame:
    """Correlation of every column with the label from one aggregate, strongest first."""
    rows = df.where(F.col(label).isin(0, 1))
    one = rows.agg(*(F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)))
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("correlation")) for i, c in enumerate(columns))))
    return one.select(pairs.alias("x")).select("x.*").orderBy(F.desc(F.abs("correlation")), "feature")


def leakage_filter(df: DataFrame, columns: list[str], label: str, limit: float = 0.95, pattern: str = LEAKAGE) -> DataFrame:
    """Features that leak the label, by name or by correlation."""
    by_name = [c for c in columns if re.search(pattern, c)]
    found = label_correlations(df, columns, label)
    named = F.col("feature").isin(by_name) if by_name else F.lit(False)
    return found.withColumns({"by_name": named, "leaks": named | F.coalesce(F.abs("correlation") > limit, F.lit(False))})


def variance_inflation(df: DataFrame, columns: list[str]) -> DataFrame:
    """VIF of each feature: the diagonal of the inverse correlation matrix."""
    m = correlation_matrix(df, columns)
    rows = [(c, float(v)) for c, v in zip(columns, np.diag(np.linalg.pinv(m)))]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def stratified_sample(df: DataFrame, strata: list[str], key: str, percent: int = 25) -> DataFrame:
    """The same share of every stratum, its size exact, by hash of the key."""
    return exact_sample(df, key, strata, percent=percent)


@dataclass(frozen=True)
class Funnel:
    """Selected features and the stages' counts."""

    features: list[str]
    stages: list[tuple[str, int]]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, n, c) for i, (n, c) in enumerate(self.stages)], "step int, stage string, n_features int")


def feature_funnel(df: DataFrame, columns: list[str], label: str, train: Column, oot: Column, keep: list[str] | None = None) -> Funnel:
    """IV, lasso, correlation, stability and leakage filters in turn."""
    fit = df.where(train)
    stages = [("candidates", len(columns))]
    iv = {r["feature"]: r["iv"] for r in iv_filter(fit, columns, label).where("kept").collect()}  # a row for each feature
    left = [c for c in columns if c in iv]
    stages.append(("information value", len(left)))
    if left:
        chosen = {r["feature"] for r in lasso_filter(fit, left, label).where("kept").collect()}
        left = [c for c in left if c in chosen]
    stages.append(("lasso", len(left)))
    if left:
        left = correlation_filter(fit, left, iv, keep)
    stages.append(("correlation", len(left)))
    if left:
        stable = {r["feature"] for r in stability_filter(df, left, train, oot).where("kept").collect()}
        left = [c for c in left if c in stable]
    stages.append(("stability", len(left)))
    if left:
        leaks = {r["feature"] for r in leakage_filter(fit, left, label).where("leaks").collect()}
        left = [c for c in left if c not in leaks]
    stages.append(("leakage", len(left)))
    return Funnel(left, stages)
