"""Quantile bins, weight of evidence, information value and population stability.

All features of a call go through one aggregate for their edges and one for
their counts: the rows are melted to (feature, bin) and counted by group.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.curves import quantile_values


def quantile_edges(df: DataFrame, columns: list[str], bins: int, approximate: bool = False) -> dict[str, list[float]]:
    """Distinct edges of equal-frequency bins for many columns at once.

    Exact edges interpolate linearly between ranks of the counted values;
    ``approximate`` ones are values of the column, from one aggregate.
    """
    levels = [i / bins for i in range(bins + 1)]
    clean = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    if not approximate:
        return {c: sorted({e for e in q if e is not None}) for c, q in quantile_values(df, clean, levels).items()}
    row = df.agg(*(F.percentile_approx(clean[c], levels, 10_000).alias(f"e{i}") for i, c in enumerate(columns))).first()
    return {c: sorted(set(row[f"e{i}"] or [])) for i, c in enumerate(columns)}


#: Up to so many edges are compared one by one, in compiled code; more of them by a function over their array.
FEW_EDGES = 32


def _passed(edges: list[float], test: Callable[[Column], Column]) -> Column:
    """How many of the edges pass a test."""
    if len(edges) > FEW_EDGES:
        return F.size(F.filter(F.array(*map(F.lit, edges)), test))
    return reduce(add, (F.when(test(F.lit(e)), 1).otherwise(0) for e in edges), F.lit(0))


def bin_of(value: Column, edges: list[float]) -> Column:
    """Right-closed bin number from 0, the lowest value included; null stays null."""
    count = _passed(edges[1:-1], lambda e: value > e)
    return F.when(value.isNotNull() & ~F.isnan(value.cast("double")), count)


def left_closed_bin(value: Column, edges: list[float]) -> Column:
    """Left-closed bin number from 0, open to both sides, as for histograms."""
    count = _passed(edges[1:-1], lambda e: value >= e)
    return F.when(value.isNotNull() & ~F.isnan(value.cast("double")), count)


def melted(df: DataFrame, bins: dict[str, Column], keep: list[Column]) -> DataFrame:
    """One row per (row, feature): the kept columns, feature and bin."""
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), b.cast("int").alias("bin")) for f, b in bins.items()))
    return df.select(*keep, F.explode(pairs).alias("_x")).select("*", "_x.feature", "_x.bin").drop("_x")


def woe_table(df: DataFrame, columns: list[str], label: str, bins: int = 10, smoothing: str = "half") -> DataFrame:
    """(feature, bin, n, bad, good, woe, iv) for all columns at once.

    ``half`` adds 0.5 to each count and half the number of bins to its total;
    ``one`` adds 0.5 and 1; ``clip`` keeps shares above 1e-4 and gives nulls a
    bin of their own (-1).
    """
    rows = df.where(F.col(label).isin(0, 1))
    edges = quantile_edges(rows, columns, bins)
    numbered = {c: bin_of(F.col(c).cast("double"), edges[c]) for c in columns if len(edges[c]) > 1}
    if not numbered:
        numbered = {c: F.lit(None) for c in columns}
    if smoothing == "clip":
        numbered = {c: F.coalesce(b, F.lit(-1)) for c, b in numbered.items()}
    t = melted(rows, numbered, [F.col(label).alias("_y")]).where("bin is not null").groupBy("feature", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("_y") == 1).alias("bad"), F.count_if(F.col("_y") == 0).alias("good"))
    all_of = Window.partitionBy("feature")
    k = F.count(F.lit(1)).over(all_of)
    more = {"half": 0.5 * k, "one": F.lit(1.0), "clip": F.lit(0.0)}[smoothing]
    add = 0.0 if smoothing == "clip" else 0.5

    def share(c: str) -> Column:
        x = (F.col(c) + add) / (F.sum(c).over(all_of) + more)
        return F.greatest(x, F.lit(1e-4)) if smoothing == "clip" else x

    t = t.withColumns({"_b": share("bad"), "_g": share("good"), "_one": (F.sum("bad").over(all_of) == 0) | (F.sum("good").over(all_of) == 0)})
    t = t.withColumn("woe", F.when(F.col("_one"), 0.0).otherwise(F.ln(F.col("_g") / F.col("_b"))))
    return t.withColumn("iv", (F.col("_g") - F.col("_b")) * F.col("woe")).drop("_b", "_g", "_one")


def information_value(df: DataFrame, columns: list[str], label: str, bins: int = 10, smoothing: str = "half") -> DataFrame:
    """(feature, iv, strength), rounded to 6 places; features without two classes or bins have 0."""
    t = woe_table(df, columns, label, bins, smoothing).groupBy("feature").agg(F.round(F.sum("iv"), 6).alias("iv"))
    every = df.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    out = every.join(t, "feature", "left").na.fill(0.0, ["iv"])
    return out.withColumn("strength", strength(F.col("iv")))


def strength(iv: Column) -> Column:
    # fixed values: the usual classes of information value
    return F.when(iv >= 0.50, "very strong").when(iv >= 0.30, "strong").when(iv >= 0.10, "medium").when(iv >= 0.02, "weak").otherwise("none")


def woe_encode(df: DataFrame, column: str, label: str, bins: int = 10, fit_on: Column | None = None) -> DataFrame:
    """Add woe_<column>, with edges and weights learned on the rows of ``fit_on``; null values get 0."""
    fit = df.where(fit_on) if fit_on is not None else df
    fit = fit.where(F.col(label).isin(0, 1))
    edges = quantile_edges(fit, [column], bins)[column]
    number = bin_of(F.col(column).cast("double"), edges)
    table = woe_table(fit, [column], label, bins).select(F.col("bin").alias("_bin"), F.col("woe").alias(f"woe_{column}"))
    # at most ``bins`` rows
    out = df.withColumn("_bin", number).join(F.broadcast(table), "_bin", "left").drop("_bin")
    return out.na.fill(0.0, [f"woe_{column}"])


def psi_table(df: DataFrame, columns: list[str], expected: Column, actual: Column, by: list[str] | None = None, bins: int = 10,
              smoothing: str = "add_one", edges: dict[str, list[float]] | None = None, min_rows: int = 10) -> DataFrame:
    """(by, feature, psi) of the actual rows against the expected ones.

    Edges are quantiles of the expected rows unless given; bins are left-closed
    and open at both ends. ``add_one`` adds one to each count and the number of
    bins to the total; ``clip`` keeps shares above 1e-4 and gives null where
    there are fewer than three edges. Below ``min_rows`` rows on a side PSI is 0.
    """
    by = by or []
    base = df.where(expected)
    edges = edges or quantile_edges(base, columns, bins)
    usable = {c: e for c, e in edges.items() if len(e) > 1} or {c: [0.0, 1.0] for c in columns}
    numbered = {c: left_closed_bin(F.col(c).cast("double"), e) for c, e in usable.items()}
    sides = F.when(expected, "e")
    e = melted(base, numbered, []).where("bin is not null").groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n_e"))
    a = melted(df.where(actual), numbered, [F.col(c) for c in by]).where("bin is not null").groupBy(*by, "feature", "bin").agg(F.count(F.lit(1)).alias("n_a"))
    # every bin of every feature, for groups that miss some: small tables
    sizes = df.sparkSession.createDataFrame([(c, b) for c, x in usable.items() for b in range(len(x) - 1)], "feature string, bin int")
    groups = a.select(*by, "feature").distinct()
    full = groups.join(sizes, "feature").join(e, ["feature", "bin"], "left").join(a, [*by, "feature", "bin"], "left").na.fill(0, ["n_e", "n_a"])
    all_of = Window.partitionBy(*by, "feature")
    k, te, ta = F.count(F.lit(1)).over(all_of), F.sum("n_e").over(all_of), F.sum("n_a").over(all_of)
    if smoothing == "clip":
        pe, pa = F.greatest(F.col("n_e") / te, F.lit(1e-4)), F.greatest(F.col("n_a") / ta, F.lit(1e-4))
    else:
        pe, pa = (F.col("n_e") + 1) / (te + k), (F.col("n_a") + 1) / (ta + k)
    parts = full.select(*by, "feature", pe.alias("pe"), pa.alias("pa"), te.alias("te"), ta.alias("ta"))
    value = F.round(F.sum((F.col("pa") - F.col("pe")) * F.ln(F.col("pa") / F.col("pe"))), 6)
    value = F.when((F.max("te") < min_rows) | (F.max("ta") < min_rows), 0.0).otherwise(value)
    if smoothing == "clip":
        few = [c for c, x in edges.items() if len(x) < 3]
        value = F.when(F.first("feature").isin(few), None).otherwise(value) if few else value
    return parts.groupBy(*by, "feature").agg(value.alias("psi"))


def equal_width_edges(low: float, high: float, bins: int) -> list[float]:
    return [low + (high - low) * i / bins for i in range(bins + 1)]


def psi_alert(psi: Column, green: float = 0.10, yellow: float = 0.25, inclusive: bool = False) -> Column:
    """GREEN below the first limit, YELLOW below the second, else RED; null stays null."""
    below = (lambda x: psi <= x) if inclusive else (lambda x: psi < x)
    return F.when(psi.isNull(), None).when(below(green), "GREEN").when(below(yellow), "YELLOW").otherwise("RED")
