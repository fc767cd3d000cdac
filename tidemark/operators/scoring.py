"""From probabilities to scores, bands and score tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.binning import bin_of, quantile_edges
from tidemark.operators.compiled import logistic_probability
from tidemark.operators.curves import exact_quantiles, join_groups

BANDS = ["CRITICO", "ALTO", "MEDIO", "BAIXO"]


def score_0_1000(prob: Column) -> Column:
    """(1 - p) * 1000 cut to a whole number and to 0..1000; 0.9 gives 99."""
    return F.least(F.greatest(((1 - prob) * 1000).cast("int"), F.lit(0)), F.lit(1000))


def score_round(prob: Column) -> Column:
    """1000 * (1 - p) rounded, halves to even."""
    return F.bround((1 - prob) * 1000).cast("int")


def risk_band(score: Column) -> Column:
    # fixed values: limits of the score bands
    return F.when(score < 300, "CRITICO").when(score < 500, "ALTO").when(score < 700, "MEDIO").when(score.isNotNull(), "BAIXO")


def pdo_score(prob: Column, base: float = 600, odds: float = 50, pdo: float = 20) -> Column:
    """Scorecard points: ``base`` at good:bad ``odds``, ``pdo`` points double them."""
    p = F.least(F.greatest(prob, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.bround(F.lit(base) + pdo * F.log2((1 - p) / p / odds)).cast("int")


def scorecard_points(coefficients: DataFrame, pdo: float = 50, base: float = 600) -> DataFrame:
    """(feature, coefficient) with points a unit: the log-odds scaled so that ``pdo`` points double the odds."""
    return coefficients.withColumns({"points": -F.col("coefficient") * pdo / F.ln(F.lit(2.0)), "base": F.lit(float(base))})


def quantile_class(df: DataFrame, prob: str, classes: int = 5, snapshot: str | None = None) -> DataFrame:
    """Add ``risk_class`` 1..classes by probability, with edges of each snapshot.

    All snapshots' edges are found together, a row each.
    """
    if snapshot is None:
        edges = quantile_edges(df, [prob], classes)[prob]
        return df.withColumn("risk_class", bin_of(F.col(prob), edges) + 1)
    levels = [i / classes for i in range(1, classes)]
    edges = exact_quantiles(df, {prob: F.col(prob)}, levels, [snapshot]).select(snapshot, F.array_distinct("quantiles").alias("_e"))
    n = F.size(F.filter("_e", lambda e: F.col(prob) > e))
    return df.join(edges, snapshot, "left").withColumn("risk_class", F.when(F.col(prob).isNotNull(), n + 1)).drop("_e")


def probability_of(model_output: str = "probability") -> Column:
    return vector_to_array(F.col(model_output))[1]


def score_columns(df: DataFrame, prob: Column, version: str, execution_id: str) -> DataFrame:
    """Score, band, rounded probability and audit columns; a missing probability counts as 0.5."""
    p = F.coalesce(F.when(~F.isnan(prob), prob), F.lit(0.5))
    return df.withColumn("prob", F.round(p, 6)).withColumns({
        "score": score_0_1000(p), "band": risk_band(score_0_1000(p)), "model_version": F.lit(version),
        "scored_at": F.current_timestamp(), "execution_id": F.lit(execution_id)})


def batch_score(model: PipelineModel, df: DataFrame, keys: list[str], version: str, execution_id: str) -> DataFrame:
    """Keys with score, band and probability; the keys stay with their rows throughout."""
    p = logistic_probability(model)
    out = score_columns(model.transform(df), probability_of(), version, execution_id) if p is None else score_columns(df, p, version, execution_id)
    return out.select(*keys, "score", "band", "prob", "model_version", "scored_at", "execution_id")


def batch_score_external(predict: Callable, df: DataFrame, keys: list[str], features: list[str], version: str, execution_id: str) -> DataFrame:
    """The same with a model from outside Spark: ``predict`` maps a pandas frame of features to probabilities."""

    def run(frames: Iterator) -> Iterator:
        for pdf in frames:
            yield pdf[keys].assign(_p=np.asarray(predict(pdf[features]), dtype=float))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.select(*keys).schema.fields)
    found = df.select(*dict.fromkeys([*keys, *features])).mapInPandas(run, f"{schema}, _p double")
    out = score_columns(found, F.col("_p"), version, execution_id)
    return out.select(*keys, "score", "band", "prob", "model_version", "scored_at", "execution_id")


def validate_scores(df: DataFrame, keys: list[str], snapshot: str, expected: list[int]) -> DataFrame:
    """(check, failures) over scored rows: range, missing, repeated keys, snapshot coverage."""
    s = F.col("score")
    rows = df.agg(F.count_if((s < 0) | (s > 1000)).alias("out_of_range"), F.count_if(s.isNull()).alias("missing"),
                  F.count_if((F.col("prob") < 0) | (F.col("prob") > 1)).alias("bad_probability"))
    repeated = df.groupBy(*keys).count().where("count > 1").agg(F.count(F.lit(1)).alias("repeated_keys"))
    present = df.select(F.col(snapshot).cast("int").alias("s")).distinct()
    absent = df.sparkSession.createDataFrame([(x,) for x in expected], "s int").join(present, "s", "left_anti").agg(F.count(F.lit(1)).alias("absent_snapshots"))
    # a row each
    one = rows.join(F.broadcast(repeated)).join(F.broadcast(absent))
    checks = ["out_of_range", "missing", "bad_probability", "repeated_keys", "absent_snapshots"]
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("check"), F.col(c).alias("failures")) for c in checks)))
    return one.select(pairs.alias("x")).select("x.*").withColumn("ok", F.col("failures") == 0)


def score_statistics(df: DataFrame, score: str, by: list[str]) -> DataFrame:
    s = F.col(score).cast("double")
    t = df.groupBy(*by).agg(F.count(s).alias("n"), F.avg(s).alias("mean"), F.stddev_samp(s).alias("std"), F.min(s).alias("least"), F.max(s).alias("most"))
    quartiles = exact_quantiles(df, {score: s}, [0.25, 0.5, 0.75], by).withColumnRenamed("quantiles", "_p").drop("feature")
    return join_groups(t, quartiles, by, "left").select(
        *by, "n", "mean", "std", "least", F.col("_p")[0].alias("p25"), F.col("_p")[1].alias("median"), F.col("_p")[2].alias("p75"), "most")


def band_distribution(df: DataFrame, band: str, by: list[str]) -> DataFrame:
    """Rows and percent by band within each group."""
    from pyspark.sql import Window

    t = df.groupBy(*by, band).agg(F.count(F.lit(1)).alias("n"))
    return t.withColumn("percent", F.col("n") * 100 / F.sum("n").over(Window.partitionBy(*by)))


def score_histogram(df: DataFrame, score: str, low: float, high: float, bins: int = 50, by: list[str] | None = None) -> DataFrame:
    """Counts in equal bins 1..bins; the value ``high`` is in the last one.

    Scores below ``low`` are in bin 0 and those above ``high`` in bin bins + 1,
    so that the bins add up to all rows with a score.
    """
    v = F.col(score).cast("double")
    b = F.when(v == high, bins).otherwise(F.width_bucket(v, F.lit(low), F.lit(high), F.lit(bins)))
    return df.where(v.isNotNull() & ~F.isnan(v)).groupBy(*(by or []), b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
