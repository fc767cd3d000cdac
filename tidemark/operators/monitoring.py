"""Score and feature drift, backtests and the overall status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.binning import psi_alert, psi_table
from tidemark.operators.metrics import agreement_rate, ranking_metrics


def score_drift(df: DataFrame, score: str, snapshot: str, train: list[int]) -> DataFrame:
    """PSI of the score in each later snapshot against the training ones, with its alert."""
    base = F.col(snapshot).isin(train)
    p = psi_table(df, [score], base, ~base, [snapshot])
    return p.withColumn("alert", psi_alert(F.col("psi")))


def feature_drift(df: DataFrame, features: list[str], expected: Column, actual: Column, by: list[str] | None = None, green: float = 0.10, yellow: float = 0.20) -> DataFrame:
    """PSI of many features in one job, with alerts; by snapshot it is the heat table."""
    return psi_table(df, features, expected, actual, by).withColumn("alert", psi_alert(F.col("psi"), green, yellow, inclusive=True))


def feature_moments(df: DataFrame, features: list[str], split: str) -> DataFrame:
    """Mean and standard deviation of each feature by split, in one aggregate."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("v")) for f in features)))
    return df.select(split, pairs.alias("x")).groupBy("x.feature", split).agg(F.avg("x.v").alias("mean"), F.stddev_samp("x.v").alias("std"), F.count("x.v").alias("n"))


def backtest(df: DataFrame, label: str, champion: str, baseline: str, by: list[str]) -> DataFrame:
    """KS and AUC of two scores by group, and what the champion gains."""
    a = ranking_metrics(df, label, champion, by).select(*by, F.col("ks").alias("ks_champion"), F.col("auc").alias("auc_champion"))
    b = ranking_metrics(df, label, baseline, by).select(*by, F.col("ks").alias("ks_baseline"), F.col("auc").alias("auc_baseline"))
    return a.join(b, by).withColumn("delta_ks", F.col("ks_champion") - F.col("ks_baseline"))


def model_monitor(df: DataFrame, models: list[str], ensemble: str, snapshot: str, train: list[int]) -> DataFrame:
    """PSI of each model's scores and its agreement with the ensemble, by snapshot."""
    base = F.col(snapshot).isin(train)
    drift = psi_table(df, models, base, ~base, [snapshot]).withColumnRenamed("feature", "model")
    parts = [agreement_rate(df.where(~base), m, ensemble, 0.5, [snapshot]).withColumn("model", F.lit(m)) for m in models]
    agree = parts[0]
    for p in parts[1:]:
        agree = agree.unionByName(p)
    return drift.join(agree, [snapshot, "model"])


def performance_drift(metrics: DataFrame, baseline: dict[str, float], limits: dict[str, float] | None = None) -> DataFrame:
    """How far each snapshot's metrics fell below the baseline; null metrics never alert."""
    limits = limits or {"ks": 0.05, "gini": 5.0, "auc": 0.03}
    out = metrics
    for m, value in baseline.items():
        out = out.withColumn(f"{m}_drop", F.lit(value) - F.col(m)).withColumn(f"{m}_alert", F.coalesce(F.col(f"{m}_drop") > limits[m], F.lit(False)))
    alerts = F.lit(False)
    for m in baseline:
        alerts = alerts | F.col(f"{m}_alert")
    return out.withColumn("degraded", alerts)


def overall_status(alerts: DataFrame, alert: str = "alert") -> DataFrame:
    """One row: any RED asks for a retrain, any YELLOW warns, else stable."""
    red, yellow = F.count_if(F.col(alert) == "RED"), F.count_if(F.col(alert) == "YELLOW")
    return alerts.agg(red.alias("n_red"), yellow.alias("n_yellow"),
                      F.when(red > 0, "RETRAIN").when(yellow > 0, "WARNING").otherwise("STABLE").alias("status"))


def retrain_status(score_psi: DataFrame, feature_alerts: DataFrame, metrics: DataFrame, min_ks: float = 0.20) -> DataFrame:
    """0, 1 or 2 with the counts behind it; see the limits in the code.

    2: a score PSI of 0.25 or more, KS below its minimum, or three RED features;
    1: a score alert of YELLOW or five YELLOW features; else 0.
    """
    s = score_psi.agg(F.count_if(F.col("psi") >= 0.25).alias("scores_red"), F.count_if((F.col("psi") >= 0.10) & (F.col("psi") < 0.25)).alias("scores_yellow"))
    f = feature_alerts.agg(F.count_if(F.col("alert") == "RED").alias("features_red"), F.count_if(F.col("alert") == "YELLOW").alias("features_yellow"))
    k = metrics.agg(F.count_if(F.col("ks") < min_ks).alias("ks_low"))
    one = s.join(F.broadcast(f)).join(F.broadcast(k))  # a row each
    code = F.when((F.col("scores_red") > 0) | (F.col("ks_low") > 0) | (F.col("features_red") >= 3), 2).when(
        (F.col("scores_yellow") > 0) | (F.col("features_yellow") >= 5), 1).otherwise(0)
    return one.withColumn("retrain_code", code)
