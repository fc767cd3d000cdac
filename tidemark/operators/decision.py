"""What a cut-off would do: swaps, recommendations, projections and money."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.binning import psi_table
from tidemark.operators.curves import among_first, exact_quantiles, join_groups
from tidemark.operators.metrics import confusion_at


def labelled_comparison(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Score statistics of labelled and unlabelled rows; a null label is no good one."""
    known = F.col(label).isNotNull()
    s = F.col(score).cast("double")
    keys = [*(by or []), "population"]
    rows = df.withColumn("population", F.when(known, "labeled").otherwise("unlabeled"))
    t = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(s).alias("mean"), F.stddev_samp(s).alias("std"), F.avg(label).alias("bad_rate"))
    medians = exact_quantiles(rows, {score: s}, [0.5], keys).select(*keys, F.col("quantiles")[0].alias("median"))
    return join_groups(t, medians, keys, "left")


def labelled_psi(df: DataFrame, label: str, score: str) -> DataFrame:
    return psi_table(df, [score], F.col(label).isNotNull(), F.col(label).isNull())


def swap_by_cutoff(df: DataFrame, label: str, old: str, new: str, old_cutoff: float, cutoffs: list[float]) -> DataFrame:
    """Moving from the old score at its cut-off to the new one at each cut-off; both high for safe.

    swap_in: newly approved; swap_out: no longer approved; with their bad rates.
    """
    counts = df.where(F.col(label).isin(0, 1)).groupBy(
        (F.col(old) >= old_cutoff).alias("was"), F.col(new).cast("double").alias("s"), F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("n"))
    t = counts.withColumn("cutoff", F.explode(F.array(*(F.lit(float(c)) for c in cutoffs))))
    now = F.col("s") >= F.col("cutoff")

    def total(on: Column, what: Column = F.col("n")) -> Column:
        return F.sum(F.when(on, what).otherwise(0))

    bad = F.col("n") * F.col("y")
    out = t.groupBy("cutoff").agg(
        F.sum("n").alias("n"), total(now).alias("approved"), total(now & ~F.col("was")).alias("swap_in"), total(~now & F.col("was")).alias("swap_out"),
        total(now, bad).alias("bad_approved"), total(now & ~F.col("was"), bad).alias("bad_in"), total(~now & F.col("was"), bad).alias("bad_out"), F.sum(bad).alias("bad"))
    return out.withColumns({
        "approval_rate": F.col("approved") / F.col("n"), "bad_rate": F.try_divide("bad_approved", "approved"), "bad_rate_in": F.try_divide("bad_in", "swap_in"),
        "bad_rate_out": F.try_divide("bad_out", "swap_out"), "overall_bad_rate": F.col("bad") / F.col("n")})


def recommend_cutoff(swaps: DataFrame, factor: float = 2.0, min_approval: float = 0.30, fallback_approval: float = 0.10) -> DataFrame:
    """The cut-off to take from a small table of cut-offs.

    The last one with a bad rate of at most ``factor`` times the overall one and
    enough approvals; else that of the least bad rate with some approvals; else the last.
    """
    good = (F.col("bad_rate") <= factor * F.col("overall_bad_rate")) & (F.col("approval_rate") >= min_approval)
    some = F.col("approval_rate") >= fallback_approval
    row = swaps.agg(
        F.max(F.when(good, F.col("cutoff"))).alias("a"), F.min_by(F.when(some, F.col("cutoff")), F.when(some, F.struct("bad_rate", "cutoff"))).alias("b"), F.max("cutoff").alias("c"))
    why = F.when(F.col("a").isNotNull(), "bad rate and approval").when(F.col("b").isNotNull(), "least bad rate").otherwise("last")
    return row.select(F.coalesce("a", "b", "c").alias("cutoff"), why.alias("reason"))


def unlabelled_projection(df: DataFrame, label: str, score: str, cutoffs: list[float]) -> DataFrame:
    """Share of unlabelled rows that each cut-off would approve."""
    counts = df.where(F.col(label).isNull()).groupBy(F.col(score).cast("double").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    t = counts.withColumn("cutoff", F.explode(F.array(*(F.lit(float(c)) for c in cutoffs))))
    approved = F.sum(F.when(F.col("s") >= F.col("cutoff"), F.col("n")).otherwise(0))
    return t.groupBy("cutoff").agg(F.sum("n").alias("n"), approved.alias("approved"), (approved * 100 / F.sum("n")).alias("percent"))


def cross_period_swap(df: DataFrame, period: str, first: object, second: object, label: str, prob: str, shares: list[float]) -> DataFrame:
    """The riskiest shares by the first period's quantiles, applied to both periods."""
    found = exact_quantiles(df.where(F.col(period) == first), {prob: F.col(prob)}, [1 - s for s in shares])
    cuts = found.select(
        F.explode(F.arrays_zip(F.array(*map(F.lit, shares)).alias("share"), F.col("quantiles").alias("cut"))).alias("x")).select(F.col("x.share").alias("share"), F.col("x.cut").alias("cut"))
    rows = df.where(F.col(period).isin(first, second)).groupBy(F.col(period).alias("period"), F.col(prob).cast("double").alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"))
    # one row for each share
    t = rows.join(F.broadcast(cuts), F.lit(True))
    over = F.col("p") >= F.col("cut")
    out = t.groupBy("share", "period").agg(
        F.first("cut").alias("cut"), F.sum("n").alias("n"), F.sum(F.when(over, F.col("n")).otherwise(0)).alias("n_over"), F.sum(F.when(over, F.col("bad")).otherwise(0)).alias("bad_over"), F.sum("bad").alias("bad"))
    return out.withColumns({"over_rate": F.col("n_over") / F.col("n"), "bad_rate_over": F.try_divide("bad_over", "n_over"), "captured": F.try_divide("bad_over", "bad")})


def ranking_overlap(df: DataFrame, label: str, score: str, oracle: str, key: str, shares: list[float]) -> DataFrame:
    """Top shares by two rankings: overlap, swaps both ways and bad rows captured."""
    n = df.count()
    tops = [math.floor(n * s) for s in shares]
    rows, first = among_first(df, score, key, tops, n)
    rows, other = among_first(rows, oracle, key, tops, n)
    found = F.array(*(F.struct(
        F.lit(s).alias("share"), F.count_if(x).alias("n_top"), F.count_if(x & y).alias("overlap"), F.count_if(x & ~y).alias("swap_in"), F.count_if(~x & y).alias("swap_out"),
        F.sum(F.when(x, F.col(label)).otherwise(0)).alias("_bad")) for s, x, y in zip(shares, first, other)))
    out = rows.agg(found.alias("_x"), F.sum(label).alias("_all"), F.count(F.lit(1)).alias("_n")).where("_n > 0").select(F.explode("_x").alias("_x"), "_all")
    return out.select("_x.*", "_all").withColumn("captured", F.col("_bad") / F.col("_all")).drop("_bad", "_all")


def tail_shift(df: DataFrame, score: str, snapshot: str, share: float = 0.1) -> DataFrame:
    """Means of the top and bottom share of scores in each snapshot, and their change from the one before."""
    s = F.col(score).cast("double")
    cuts = exact_quantiles(df, {score: s}, [share, 1 - share], [snapshot]).select(snapshot, F.col("quantiles").alias("_c"))
    t = df.join(cuts, snapshot).groupBy(snapshot).agg(
        F.avg(F.when(s >= F.col("_c")[1], s)).alias("top_mean"), F.avg(F.when(s <= F.col("_c")[0], s)).alias("bottom_mean"))
    w = Window.orderBy(snapshot)
    return t.withColumns({"top_change": F.col("top_mean") - F.lag("top_mean").over(w), "bottom_change": F.col("bottom_mean") - F.lag("bottom_mean").over(w)})


def financial_impact(df: DataFrame, label: str, score: str, cutoffs: list[float], lgd: float = 44.89, revenue: float = 10.0) -> DataFrame:
    """Money by cut-off: revenue of approved good rows, loss of approved bad ones, and against approving all.

    ``lgd`` is the loss for a bad row; ``median_open_value`` gives it from data.
    """
    m = confusion_at(df, label, score, cutoffs).select("cutoff", "tp", "fp", "tn", "fn")
    net_all = (F.col("tp") + F.col("fn")) * revenue - (F.col("fp") + F.col("tn")) * lgd
    return m.withColumns({
        "revenue": F.col("tp") * revenue, "loss": F.col("fp") * lgd, "avoided_loss": F.col("tn") * lgd, "lost_revenue": F.col("fn") * revenue}).withColumns({
            "net": F.col("revenue") - F.col("loss"), "net_approve_all": net_all}).withColumn("gain", F.col("net") - F.col("net_approve_all"))


def median_open_value(df: DataFrame, value: str) -> DataFrame:
    return exact_quantiles(df.where(F.col(value) > 0), {value: F.col(value)}, [0.5]).agg(F.max(F.col("quantiles")[0]).alias("lgd"))
