"""Score curves: counts by score, cumulated without a single-task window.

KS, AUC, ROC, confusion at cut-offs, capture and approval curves are all
projections of the cumulated counts of bad and good rows by distinct score.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut_points(df: DataFrame, column: str, parts: int) -> list[float]:
    """Up to ``parts`` - 1 approximate quantiles of a numeric column, distinct."""
    if parts < 2:
        return []
    return sorted(set(df.approxQuantile(column, [i / parts for i in range(1, parts)], 0.25 / parts)))


def part_of(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts lie below the value: a part that keeps the order."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts))
    blocks = [cuts[i:i + step] for i in range(0, len(cuts), step)] + [[]]
    # whole blocks below the value by their last cuts, then the cuts of the next block
    whole = F.size(F.filter(F.array(*(F.lit(b[-1]) for b in blocks if len(b) == step)), lambda c: c < value))
    rest = F.element_at(F.array(*(F.array(*map(F.lit, b)).cast("array<double>") for b in blocks)), whole + 1)
    return whole * step + F.size(F.filter(rest, lambda c: c < value))


def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys of which null is a value too."""
    return left.join(right, [left[k].eqNullSafe(right[k]) for k in keys], how).drop(*(right[k] for k in keys))


def prefix_sums(df: DataFrame, order: list[str], sums: list[str], by: list[str] | None = None, parts: int | None = None,
                cuts: list[float] | None = None) -> DataFrame:
    """Add before_<c> and total_<c> for each summed column, in the order given.

    The first order column is cut into parts of similar size, at ``cuts`` where
    they are given; sums run within (by, part) and are shifted by the totals of
    the parts before, which are few.
    """
    by = by or []
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = cut_points(df, order[0], parts) if cuts is None else cuts
    rows = df.withColumn("_part", part_of(F.col(order[0]).cast("double"), cuts))
    totals = rows.groupBy(*by, "_part").agg(*(F.sum(c).alias(f"_t_{c}") for c in sums))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    shifts = totals.select(
        *by, "_part", *(F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_s_{c}") for c in sums),
        *(F.sum(f"_t_{c}").over(whole).alias(f"total_{c}") for c in sums))
    within = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumns({f"_l_{c}": F.coalesce(F.sum(c).over(within), F.lit(0)) for c in sums})
    joined = join_groups(local, shifts, [*by, "_part"])
    return joined.withColumns({f"before_{c}": F.col(f"_l_{c}") + F.col(f"_s_{c}") for c in sums}).drop(
        "_part", *(f"_l_{c}" for c in sums), *(f"_s_{c}" for c in sums))


def exact_quantiles(df: DataFrame, values: dict[str, Column], levels: list[float], by: list[str] | None = None) -> DataFrame:
    """(by, feature, quantiles array): exact quantiles of several values, in each group.

    Equal to ``percentile``, which interpolates linearly, without its buffer of
    all distinct values: values are counted, the counts cumulated in parts of
    their range, and the ranks that a level falls between looked up. Nulls don't
    count; a group without values has no row.
    """
    by = by or []
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), c.cast("double").alias("value")) for f, c in values.items())))
    rows = df.select(*by, pairs.alias("_x")).select(*by, "_x.feature", "_x.value").where("value is not null")
    counts = rows.groupBy(*by, "feature", "value").agg(F.count(F.lit(1)).alias("n"))
    placed = prefix_sums(counts, ["value"], ["n"], [*by, "feature"], parts, cut_points(rows, "value", parts))
    place = [(F.col("total_n") - 1) * F.lit(float(q)) for q in levels]

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("before_n") <= rank) & (rank < F.col("before_n") + F.col("n")), F.col("value")))

    found = placed.groupBy(*by, "feature").agg(
        F.max("total_n").alias("total_n"), *(at(F.floor(p)).alias(f"_low_{i}") for i, p in enumerate(place)), *(at(F.ceil(p)).alias(f"_high_{i}") for i, p in enumerate(place)))

    def between(i: int) -> Column:
        low, high = F.col(f"_low_{i}"), F.col(f"_high_{i}")
        return F.when(low == high, low).otherwise((F.ceil(place[i]) - place[i]) * low + (place[i] - F.floor(place[i])) * high)

    return found.select(*by, "feature", F.array(*(between(i) for i in range(len(levels)))).alias("quantiles"))


def quantile_values(df: DataFrame, values: dict[str, Column], levels: list[float]) -> dict[str, list[float | None]]:
    """The quantiles of several values over all rows: a row each, so they fit on the driver."""
    found = {r["feature"]: r["quantiles"] for r in exact_quantiles(df, values, levels).collect()}
    return {f: found.get(f, [None] * len(levels)) for f in values}


def score_counts(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """(by, score, bad, good): rows with a label and a score, counted by score."""
    rows = df.where(F.col(label).isin(0, 1) & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    return rows.groupBy(*(by or []), F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("bad"), F.count_if(F.col(label) == 0).alias("good"))


def curve(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Counts by score with before_* (below the score) and total_*."""
    return prefix_sums(score_counts(df, label, score, by), ["score"], ["bad", "good"], by)


def global_rank(df: DataFrame, score: str, key: str, descending: bool = True, parts: int | None = None) -> DataFrame:
    """Add ``rank`` from 1 by score, ties by a numeric key, and ``n_rows``.

    Rows are numbered within (score, part of the key); the numbers of rows
    before come from cumulated counts, so that neither the whole table nor all
    rows of one score meet in one task.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sign = -1 if descending else 1
    rows = df.withColumns({"_o": F.col(score).cast("double") * sign, "_k": part_of(F.col(key).cast("double"), cut_points(df, key, parts))})
    counts = prefix_sums(rows.groupBy("_o", "_k").agg(F.count(F.lit(1)).alias("n")), ["_o", "_k"], ["n"], parts=parts)
    within = F.row_number().over(Window.partitionBy("_o", "_k").orderBy(key))
    ranked = rows.withColumn("_r", within).join(counts.select("_o", "_k", "before_n", "total_n"), ["_o", "_k"])
    return ranked.withColumn("rank", F.col("_r") + F.col("before_n")).withColumnRenamed("total_n", "n_rows").drop("_o", "_k", "_r", "before_n")


def _rank_cuts(df: DataFrame, score: str, key: str, ranks: list[int], sign: int) -> dict[int, tuple] | None:
    """The (signed score, key) of the rows at these ranks; None if rows equal in both go on beyond one, or one isn't found."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select((F.col(score).cast("double") * sign).alias("_o"), F.col(key).alias("_key"), part_of(F.col(key).cast("double"), cut_points(df, key, parts)).alias("_k"))
    placed = prefix_sums(rows.groupBy("_o", "_k").agg(F.count(F.lit(1)).alias("n")), ["_o", "_k"], ["n"], parts=parts)
    holds = reduce(or_, ((F.col("before_n") < r) & (F.col("before_n") + F.col("n") >= r) for r in ranks))
    groups = placed.where(holds).select("_o", "_k", "before_n").collect()
    if not groups:
        return None
    of_group = [(F.col("_o") == g["_o"]) & (F.col("_k") == g["_k"]) for g in groups]
    before = F.coalesce(*(F.when(at, F.lit(g["before_n"])) for at, g in zip(of_group, groups)))
    w = Window.partitionBy("_o", "_k").orderBy("_key")
    numbered = rows.where(reduce(or_, of_group)).withColumns({"_r": F.row_number().over(w) + before, "_more": F.lead("_key").over(w) == F.col("_key")})
    found = numbered.where(F.col("_r").isin(ranks)).collect()
    if len(found) < len(ranks) or any(r["_more"] for r in found):
        return None
    return {r["_r"]: (r["_o"], r["_key"]) for r in found}


def among_first(df: DataFrame, score: str, key: str, ranks: list[int], n_rows: int, descending: bool = True) -> tuple[DataFrame, list[Column]]:
    """Rows with a condition for each of some ranks: that the row's ``global_rank`` is up to it.

    Only the rows at these ranks are looked up, in counts by (score, part of the
    key) and in the few groups that hold them; the others are compared with them
    and never ordered. Where rows without a score or key, or equal in both, leave a
    rank open, all rows are ranked.
    """
    inner = sorted({r for r in ranks if 0 < r < n_rows})
    sign, name = -1 if descending else 1, f"_rank_{score}"
    cuts = {}
    if inner:
        whole = df.where(F.col(score).isNull() | F.col(key).isNull()).isEmpty()
        cuts = _rank_cuts(df, score, key, inner, sign) if whole else None
    if cuts is None:
        ranked = global_rank(df, score, key, descending).withColumnRenamed("rank", name).drop("n_rows")
        return ranked, [F.col(name) <= r for r in ranks]
    o = F.col(score).cast("double") * sign

    def up_to(r: int) -> Column:
        if r not in cuts:
            return F.lit(r > 0)
        return (o < cuts[r][0]) | ((o == cuts[r][0]) & (F.col(key) <= cuts[r][1]))

    return df, [up_to(r) for r in ranks]


def slice_of(beyond: list[Column]) -> Column:
    """How many of the cuts a row lies beyond, from conditions of lying up to them."""
    return sum((F.when(c, 0).otherwise(1) for c in beyond), F.lit(0))


def tile(rank: Column, n_rows: Column, tiles: int) -> Column:
    """``ntile`` of a row from its rank and the number of rows."""
    size, more = F.floor(n_rows / tiles), n_rows % tiles
    head = more * (size + 1)
    late = more + F.floor((rank - head - 1) / F.greatest(size, F.lit(1))) + 1
    return F.when(rank <= head, F.floor((rank - 1) / (size + 1)) + 1).otherwise(late).cast("int")
