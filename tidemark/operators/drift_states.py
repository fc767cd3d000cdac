"""Drift from stored states: each snapshot is read once, and later comparisons read its state only.

A state has, for each feature of a snapshot, counts in the baseline's bins, the
moments and a KLL quantile sketch. States lie in a folder a snapshot; those of
several snapshots merge. Against the baseline whose edges are stored, PSI is exact;
against any other choice of snapshots it comes from their merged sketches.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.binning import left_closed_bin, quantile_edges
from tidemark.sources import files
from tidemark.sources.io import write_overwrite, write_replace_partition

#: Size of the sketches; ranks of single ones are off by about 2.3 / K**0.9, 0.24 %, with a probability of 99 %.
K = 2000
RANK_ERROR = 2.3 / K**0.9


def start(df: DataFrame, path: str, features: list[str], snapshot: str, baseline: list[int], bins: int = 10) -> dict[str, list[float]]:
    """Find the features' quantile edges on the baseline's snapshots and store them; states begin anew."""
    edges = quantile_edges(df.where(F.col(snapshot).isin(baseline)), features, bins)
    edges = {c: e if len(e) > 1 else [0.0, 1.0] for c, e in edges.items()}
    files.delete(df.sparkSession, path)
    write_overwrite(df.sparkSession.createDataFrame(list(edges.items()), "feature string, edges array<double>").coalesce(1), f"{path}/_edges")
    return edges


def stored_edges(spark: SparkSession, path: str) -> dict[str, list[float]]:
    return {r["feature"]: r["edges"] for r in spark.read.parquet(f"{path}/_edges").collect()}


def states(df: DataFrame, edges: dict[str, list[float]], snapshot: str) -> DataFrame:
    """(snapshot, feature, n, n_missing, mean, squares, least, most, counts, sketch) from one aggregate.

    ``squares`` are the squared deviations from the mean. NaN counts as missing.
    """
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in edges}
    entries = F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), v.alias("v"), left_closed_bin(v, edges[c]).alias("bin")) for c, v in value.items())))
    rows = df.select(F.col(snapshot).cast("long").alias("snapshot"), entries.alias("x")).select("snapshot", "x.*")
    most_bins = max(len(e) for e in edges.values()) - 1
    return rows.groupBy("snapshot", "feature").agg(
        F.count("v").alias("n"), F.count_if(F.col("v").isNull()).alias("n_missing"), F.avg("v").alias("mean"), (F.count("v") * F.var_pop("v")).alias("squares"),
        F.min("v").alias("least"), F.max("v").alias("most"), F.array(*(F.count_if(F.col("bin") == b) for b in range(most_bins))).alias("counts"), F.kll_sketch_agg_double("v", K).alias("sketch"))


def add_snapshots(df: DataFrame, path: str, snapshot: str, again: list[int] | None = None) -> list[int]:
    """Store the states of the snapshots that have none, and of those named ``again``; returns which.

    Only their rows are read; where ``snapshot`` is a partition column, only their
    folders. Each snapshot's folder is replaced as a whole.
    """
    spark = df.sparkSession
    have = {int(name.partition("=")[2]) for name in files.folders(spark, path)}
    present = {int(r[0]) for r in df.select(snapshot).where(F.col(snapshot).isNotNull()).distinct().collect()}
    new = sorted(present - have | present & set(again or []))
    if new:
        rows = states(df.where(F.col(snapshot).isin(new)), stored_edges(spark, path), snapshot)
        write_replace_partition(rows.repartition("snapshot"), path, ["snapshot"])
    return new


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("snapshot", F.col("snapshot").cast("long"))


def moments(spark: SparkSession, path: str, groups: dict[str, list[int]] | None = None) -> DataFrame:
    """(name, feature, n, mean, std, least, most) of groups of snapshots, or of each snapshot, from the states alone."""
    s = stored(spark, path)
    if groups is None:
        s = s.withColumn("name", F.col("snapshot").cast("string"))
    else:
        s = s.withColumn("name", F.explode(F.filter(F.array(*(F.when(F.col("snapshot").isin(v), F.lit(k)) for k, v in groups.items())), lambda x: x.isNotNull())))
    whole = s.groupBy("name", "feature").agg(F.sum("n").alias("n"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("mean"), F.min("least").alias("least"), F.max("most").alias("most"))
    # deviations merge around the common mean, so that no large squares cancel
    off = s.select("name", "feature", F.col("n").alias("m"), F.col("mean").alias("own"), "squares").join(whole, ["name", "feature"])
    squares = off.groupBy("name", "feature").agg(F.sum(F.col("squares") + F.col("m") * (F.col("own") - F.col("mean")) * (F.col("own") - F.col("mean"))).alias("q"))
    std = F.when(F.col("n") > 1, F.sqrt(F.col("q") / (F.col("n") - 1)))
    return whole.join(squares, ["name", "feature"]).select("name", "feature", "n", "mean", std.alias("std"), "least", "most")


def _psi(expected: Column, actual: Column) -> Column:
    """PSI of counts in bins, smoothed by one row a bin."""
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    k = F.size(expected)
    share = lambda c: F.transform(c, lambda x: (x + 1) / (total(c) + k))
    terms = F.zip_with(share(expected), share(actual), lambda e, a: (a - e) * F.ln(a / e))
    return F.round(total(terms), 6)


def drift(spark: SparkSession, path: str, baseline: list[int], min_rows: int = 10) -> DataFrame:
    """(snapshot, feature, psi) of the other snapshots against the baseline, in the stored bins: the values of a full run."""
    edges = F.create_map(*(x for c, e in stored_edges(spark, path).items() for x in (F.lit(c), F.lit(len(e) - 1))))
    s = stored(spark, path).withColumn("counts", F.slice("counts", 1, edges[F.col("feature")]))
    inside = F.col("snapshot").isin(baseline)
    base = s.where(inside).select("feature", F.posexplode("counts").alias("bin", "c")).groupBy("feature", "bin").agg(F.sum("c").alias("c"))
    base = base.groupBy("feature").agg(F.transform(F.array_sort(F.collect_list(F.struct("bin", "c"))), lambda x: x["c"]).alias("expected"))  # an entry for each bin
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)
    few = (total(F.col("expected")) < min_rows) | (total(F.col("counts")) < min_rows)
    return s.where(~inside).join(base, "feature").select("snapshot", "feature", F.when(few, 0.0).otherwise(_psi(F.col("expected"), F.col("counts"))).alias("psi"))


def rebased_drift(spark: SparkSession, path: str, baseline: list[int], bins: int = 10) -> DataFrame:
    """(snapshot, feature, psi) against any snapshots as baseline, by their merged sketches.

    Shares of bins are differences of two ranks, so each is off by
    2 * RANK_ERROR at most (99 %), for values that don't heap at an edge.
    """
    s = stored(spark, path).where("n > 0")
    inside = F.col("snapshot").isin(baseline)
    levels = F.array(*(F.lit(i / bins) for i in range(1, bins)))
    base = s.where(inside).groupBy("feature").agg(F.kll_merge_agg_double("sketch").alias("merged"), F.sum("n").alias("m"))
    # a row for each feature; ranks are asked for fixed values only
    edges = {r["feature"]: sorted(set(r["q"])) for r in base.select("feature", F.kll_sketch_get_quantile_double("merged", levels).alias("q")).collect()}

    def counts(sketch: str, n: str) -> Column:
        out = F.lit(None)
        for f, inner in edges.items():
            # ranks count values up to and with the one asked for; bins are left-closed, so ask for the one just below
            below = F.array(*(F.lit(math.nextafter(e, -math.inf)) for e in inner))
            ranks = F.concat(F.array(F.lit(0.0)), F.kll_sketch_get_rank_double(sketch, below), F.array(F.lit(1.0)))
            out = F.when(F.col("feature") == f, ranks).otherwise(out)
        return F.transform(F.sequence(F.lit(1), F.size(out) - 1), lambda i: (F.get(out, i) - F.get(out, i - 1)) * F.col(n))

    joined = s.where(~inside).join(base, "feature")
    return joined.select("snapshot", "feature", _psi(counts("merged", "m"), counts("sketch", "n")).alias("psi"))
