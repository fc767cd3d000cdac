"""Row-wise derived features."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clean import safe_divide
from tidemark.operators.binning import bin_of, quantile_edges
from tidemark.operators.curves import quantile_values


def missing_features(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """Per group of columns: number and share of nulls; and a bit pattern of which groups are wholly missing."""
    out, bits = {}, []
    for i, (name, columns) in enumerate(groups.items()):
        n = reduce(add, (F.col(c).isNull().cast("int") for c in columns))
        out |= {f"{name}_n_missing": n, f"{name}_missing_share": n / len(columns)}
        bits.append((n == len(columns)).cast("int") * (1 << i))
    out["missing_pattern"] = reduce(add, bits)
    return df.withColumns(out)


def null_flags(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({f"{c}_is_null": F.col(c).isNull().cast("int") for c in columns})


def interactions(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Product, difference, absolute gap and ratio of column pairs."""
    out = {}
    for a, b in pairs:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        out |= {f"{a}_x_{b}": x * y, f"{a}_minus_{b}": x - y, f"{a}_gap_{b}": F.abs(x - y), f"{a}_per_{b}": safe_divide(x, y)}
    return df.withColumns(out)


def combination_flags(df: DataFrame, pairs: list[tuple[str, str]], level: float = 0.5) -> DataFrame:
    """1 where both columns of a pair are above their quantile at ``level``."""
    columns = sorted({c for p in pairs for c in p})
    limits = quantile_values(df, {c: F.col(c) for c in columns}, [level])
    high = {c: F.coalesce(F.col(c) > F.lit(limits[c][0]), F.lit(False)) for c in columns}
    return df.withColumns({f"{a}_{b}_both_high": (high[a] & high[b]).cast("int") for a, b in pairs})


def domain_ratios(df: DataFrame, ratios: dict[str, tuple[str, str]], low: float | None = None, high: float | None = None) -> DataFrame:
    """Named ratios with 0 for an empty denominator, clipped to a range."""

    def one(a: str, b: str) -> Column:
        r = safe_divide(F.col(a), F.col(b))
        r = F.greatest(r, F.lit(low)) if low is not None else r
        return F.least(r, F.lit(high)) if high is not None else r

    return df.withColumns({n: one(a, b) for n, (a, b) in ratios.items()})


def bucket(c: Column, edges: list[float]) -> Column:
    """Right-closed bucket number between the edges; null outside them."""
    out = F.lit(None).cast("int")
    for i in reversed(range(len(edges) - 1)):
        out = F.when((c > edges[i]) & (c <= edges[i + 1]), i).otherwise(out)
    return out


def temporal_features(df: DataFrame, since_first: str, since_last: str, count: str, span: str) -> DataFrame:
    """Tenure and recency buckets, recency gap, velocity, density, active window, trend and regularity."""
    first, last, n, days = (F.col(c).cast("double") for c in (since_first, since_last, count, span))
    return df.withColumns({
        "tenure_bucket": bucket(first, [-1, 30, 90, 180, 365, float("inf")]),
        "recency_bucket": bucket(last, [-1, 7, 30, 90, 180, float("inf")]),
        "lifecycle": F.when(last > 90, "lapsed").when(first <= 90, "new").otherwise("active"),
        "recency_gap": first - last, "velocity": safe_divide(n, first), "density": safe_divide(n, days + 1),
        "active_window": safe_divide(days, first), "recent_trend": safe_divide(first - last, first), "regularity": safe_divide(days, n)})


def signed_log(c: Column) -> Column:
    return F.signum(c) * F.log1p(F.abs(c))


def signed_sqrt(c: Column) -> Column:
    return F.signum(c) * F.sqrt(F.abs(c))


def score_quantile(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Add <column>_q<bins>, the quantile bin of the value, the median's for nulls."""
    edges = quantile_edges(df, [column], bins)[column]
    (median,) = quantile_values(df, {column: F.col(column)}, [0.5])[column]
    value = F.coalesce(F.col(column).cast("double"), F.lit(median).cast("double"))
    return df.withColumn(f"{column}_q{bins}", bin_of(value, edges))


#: Up to this many values, shares are sent to the tasks; beyond it rows are shuffled by value.
FEW_VALUES = 1_000_000


def frequency_encode(df: DataFrame, column: str, fit_on: Column | None = None) -> DataFrame:
    """Add <column>_freq, the value's share of the fitted rows; 0 for new and missing values.

    Values are counted first: a shuffle by few values would leave all rows to as
    many tasks, and so would all that reads the result.
    """
    fit = df.where(fit_on) if fit_on is not None else df
    counts = fit.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    total = fit.agg(F.count(F.lit(1)).alias("_all"))
    shares = counts.join(F.broadcast(total)).select(column, (F.col("_n") / F.col("_all")).alias(f"{column}_freq"))
    few = shares.limit(FEW_VALUES + 1).count() <= FEW_VALUES
    return df.join(F.broadcast(shares) if few else shares, column, "left").na.fill(0.0, [f"{column}_freq"])


def fit_domain_pca(df: DataFrame, domains: dict[str, tuple[list[str], int]]) -> PipelineModel:
    """Median imputation, standardisation and k components for each domain, fitted on the rows given."""
    stages = []
    for name, (columns, k) in domains.items():
        filled = [f"_{c}_{name}" for c in columns]
        stages += [Imputer(inputCols=columns, outputCols=filled, strategy="median"),
                   VectorAssembler(inputCols=filled, outputCol=f"_{name}"),
                   StandardScaler(inputCol=f"_{name}", outputCol=f"_{name}_s", withMean=True),
                   PCA(k=k, inputCol=f"_{name}_s", outputCol=f"_{name}_pca")]
    return Pipeline(stages=stages).fit(df)


def apply_domain_pca(model: PipelineModel, df: DataFrame, domains: dict[str, tuple[list[str], int]]) -> DataFrame:
    out = model.transform(df)
    parts = {f"{name}_pc{i + 1}": vector_to_array(F.col(f"_{name}_pca"))[i] for name, (_, k) in domains.items() for i in range(k)}
    return out.withColumns(parts).select(*df.columns, *parts)
