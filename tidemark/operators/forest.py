"""Importances of a random forest, grown over counted rows.

Trees see the bins of the features only, so rows of the same bins are counted
once and a tree's bootstrap sample takes a Poisson number of each: of n rows
together as many as of n rows apart. All trees grow together, a level a step,
and no tree, node or row reaches the driver.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.binning import bin_of, quantile_edges
from tidemark.sources.io import written


def counted(df: DataFrame, features: list[str], bins: int) -> DataFrame:
    """(_bins, n0, n1, w0, w1): rows by the bins of their features, with number and mean weight by label; a missing value gets the median's bin."""
    rows = df.where(F.col("_label").isin(0, 1))
    edges = quantile_edges(rows, features, bins, approximate=True)
    # an approximate edge is a value of the column; values up to it are below
    numbers = []
    for f in features:
        x = F.col(f).cast("double")
        middle = edges[f][len(edges[f]) // 2] if edges[f] else 0.0
        # the least value has a bin of its own
        numbers.append(bin_of(F.when(x.isNull() | F.isnan(x), F.lit(middle)).otherwise(x), [-math.inf, *edges[f], math.inf]).cast("int"))
    one = F.col("_label") == 1
    return rows.groupBy(F.array(*numbers).alias("_bins")).agg(
        F.count_if(~one).alias("n0"), F.count_if(one).alias("n1"), F.coalesce(F.avg(F.when(~one, F.col("_weight"))), F.lit(0.0)).alias("w0"),
        F.coalesce(F.avg(F.when(one, F.col("_weight"))), F.lit(0.0)).alias("w1"))


def bootstrapped(counts: DataFrame, trees: int, seed: int) -> DataFrame:
    """(_bins, tree, n0, n1, w0, w1): the sample of each tree, w being weights in all."""

    @F.pandas_udf("array<int>")
    def draws(n: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([np.random.default_rng([seed, int(a) & 0xFFFFFFFFFFFFFFFF]).poisson(k, trees).astype(np.int32) for k, a in zip(n, at)])

    drawn = counts.withColumns({f"_k{y}": draws(F.col(f"n{y}"), F.xxhash64("_bins", F.lit(y))) for y in (0, 1)})
    each = drawn.select("_bins", "w0", "w1", F.posexplode(F.arrays_zip("_k0", "_k1")).alias("tree", "_k"))
    out = each.select("_bins", "tree", F.col("_k._k0").alias("n0"), F.col("_k._k1").alias("n1"), "w0", "w1").where("n0 + n1 > 0")
    return out.withColumns({"w0": F.col("n0") * F.col("w0"), "w1": F.col("n1") * F.col("w1")})


def _gini(w0: Column, w1: Column) -> Column:
    """Weight of a node times its gini impurity."""
    return F.when(w0 + w1 > 0, 2 * w0 * w1 / (w0 + w1)).otherwise(0.0)


def grow(sample: DataFrame, n_features: int, depth: int, least: int, seed: int) -> DataFrame:
    """(tree, feature, gain): impurity that a tree's splits by a feature take away, times the nodes' weights.

    A node splits by the best cut of about the root of the number of features,
    drawn for each node, that leaves ``least`` sampled rows on both sides.
    """
    tried = max(math.ceil(math.sqrt(n_features)), 1)

    def chosen(node: Column) -> Column:
        """The features that a node tries: the first ones in the order of a hash."""
        order = F.array_sort(F.transform(F.sequence(F.lit(0), F.lit(n_features - 1)), lambda f: F.struct(F.xxhash64("tree", node, f, F.lit(seed)).alias("h"), f.alias("f"))))
        return F.transform(F.slice(order, 1, tried), lambda x: x["f"])

    root = F.lit(1).cast("long")
    rows, gains = sample.withColumns({"node": root, "_tried": chosen(root)}), None
    for _ in range(depth):
        cells = rows.select("tree", "node", "_bins", "n0", "n1", "w0", "w1", F.explode("_tried").alias("feature")).groupBy(
            "tree", "node", "feature", F.element_at("_bins", F.col("feature") + 1).alias("bin")).agg(
                F.sum(F.col("n0") + F.col("n1")).alias("n"), F.sum("w0").alias("w0"), F.sum("w1").alias("w1"))
        node = Window.partitionBy("tree", "node", "feature")
        so_far = node.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        sums = cells.select("tree", "node", "feature", "bin", *(F.sum(c).over(so_far).alias(f"l_{c}") for c in ("n", "w0", "w1")), *(F.sum(c).over(node).alias(f"t_{c}") for c in ("n", "w0", "w1")))
        l0, l1, t0, t1 = (F.col(c) for c in ("l_w0", "l_w1", "t_w0", "t_w1"))
        gain = _gini(t0, t1) - _gini(l0, l1) - _gini(F.greatest(t0 - l0, F.lit(0.0)), F.greatest(t1 - l1, F.lit(0.0)))
        good = sums.where((F.col("l_n") >= least) & (F.col("t_n") - F.col("l_n") >= least)).withColumn("gain", gain).where(F.col("gain") > 1e-9 * (t0 + t1))
        best = written(good.groupBy("tree", "node").agg(F.max(F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("b")).select(
            "tree", "node", "b.gain", (-F.col("b.col2")).alias("feature"), (-F.col("b.col3")).alias("bin"),
            chosen(F.col("node") * 2).alias("_low"), chosen(F.col("node") * 2 + 1).alias("_high")))
        found = best.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        gains = found if gains is None else gains.unionByName(found)
        beyond = F.element_at("_bins", F.col("feature") + 1) > F.col("bin")
        rows = written(rows.drop("_tried").join(best, ["tree", "node"]).select(
            "_bins", "tree", "n0", "n1", "w0", "w1", (F.col("node") * 2 + beyond.cast("long")).alias("node"), F.when(beyond, F.col("_high")).otherwise(F.col("_low")).alias("_tried")))
        if rows.isEmpty():
            break
    return gains.groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))


def forest_importances(df: DataFrame, features: list[str], trees: int = 500, depth: int = 12, least: int = 50, seed: int = 42, bins: int = 32,
                       groups: dict[str, str] | None = None) -> DataFrame:
    """Importances of a forest's features, each tree's adding up to 1, with shares and the feature's group."""
    sample = written(bootstrapped(written(counted(df, features, bins)), trees, seed))
    gains = grow(sample, len(features), depth, least, seed)
    of_tree = gains.withColumn("part", F.col("gain") / F.sum("gain").over(Window.partitionBy("tree")))
    totals = of_tree.groupBy("feature").agg(F.sum("part").alias("part"))
    names = df.sparkSession.createDataFrame([(i, f, (groups or {}).get(f, f.split("_")[0])) for i, f in enumerate(features)], "i int, feature string, feature_group string")
    # a row a feature
    joined = names.join(totals.withColumnRenamed("feature", "i"), "i", "left").na.fill(0.0, ["part"])
    share = F.coalesce(F.try_divide(F.col("part"), F.sum("part").over(Window.partitionBy())), F.lit(0.0))
    return joined.select("feature", share.alias("importance"), share.alias("share"), "feature_group").orderBy(F.desc("importance"), "feature")
