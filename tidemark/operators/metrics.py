"""Model-quality metrics as aggregates over score curves."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.binning import bin_of, quantile_edges
from tidemark.operators.curves import among_first, curve, exact_quantiles, prefix_sums, score_counts, slice_of


def ranking_metrics(df: DataFrame, label: str, score: str, by: list[str] | None = None, min_rows: int = 0) -> DataFrame:
    """n, n_bad, bad_rate, ks, auc and gini by group; a higher score means riskier.

    Rows without a label or score don't count. Ties count half for the AUC and
    form one step for KS. Groups with fewer than ``min_rows`` rows or one class
    have null metrics.
    """
    return ranking_of_counts(score_counts(df, label, score, by), by, min_rows)


def ranking_of_counts(counts: DataFrame, by: list[str] | None = None, min_rows: int = 0) -> DataFrame:
    """``ranking_metrics`` of rows that are counted by score already, as by ``score_counts``."""
    by = by or []
    c = prefix_sums(counts, ["score"], ["bad", "good"], by)
    step = F.abs((F.col("before_bad") + F.col("bad")) / F.col("total_bad") - (F.col("before_good") + F.col("good")) / F.col("total_good"))
    usable = (F.col("total_bad") > 0) & (F.col("total_good") > 0)
    pairs = F.sum(F.col("bad") * (F.col("before_good") + F.col("good") / 2))
    out = c.groupBy(*by).agg(
        (F.sum("bad") + F.sum("good")).alias("n"), F.sum("bad").alias("n_bad"),
        (F.sum("bad") / (F.sum("bad") + F.sum("good"))).alias("bad_rate"),
        F.max(F.when(usable, step)).alias("ks"),
        F.when(F.max("total_bad") * F.max("total_good") > 0, pairs / F.max("total_bad") / F.max("total_good")).alias("auc"))
    enough = F.col("n") >= min_rows
    return out.withColumns({"ks": F.when(enough, F.col("ks")), "auc": F.when(enough, F.col("auc"))}).withColumn("gini", (2 * F.col("auc") - 1) * 100)


def roc_points(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """A point for each distinct score as threshold: at or above it is called bad."""
    c = curve(df, label, score, by)
    tp, fp = F.col("total_bad") - F.col("before_bad"), F.col("total_good") - F.col("before_good")
    return c.select(
        *(by or []), F.col("score").alias("threshold"), (tp / F.col("total_bad")).alias("tpr"), (fp / F.col("total_good")).alias("fpr"),
        (tp / (tp + fp)).alias("precision"))


def best_threshold(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """The threshold with the greatest TPR - FPR, the smallest one if tied, and its metrics."""
    p = roc_points(df, label, score, by).withColumn("youden", F.col("tpr") - F.col("fpr"))
    best = F.max_by(F.struct("threshold", "tpr", "fpr", "precision", "youden"), F.struct("youden", -F.col("threshold")))
    out = p.groupBy(*(by or [])).agg(best.alias("b")).select(*(by or []), "b.*")
    return out.withColumn("f1", 2 * F.col("precision") * F.col("tpr") / (F.col("precision") + F.col("tpr")))


def confusion_at(df: DataFrame, label: str, score: str, cutoffs: list[float], by: list[str] | None = None) -> DataFrame:
    """Confusion counts and rates at approval cut-offs; a high score means safe.

    A row is approved at or above the cut-off; positive is a good row that is
    approved, so precision is the share of good rows among the approved.
    """
    counts = score_counts(df, label, score, by).withColumn("cutoff", F.explode(F.array(*(F.lit(float(c)) for c in cutoffs))))
    ok = F.col("score") >= F.col("cutoff")

    def total(c: str, on: Column) -> Column:
        return F.sum(F.when(on, F.col(c)).otherwise(0))

    out = counts.groupBy(*(by or []), "cutoff").agg(
        total("good", ok).alias("tp"), total("bad", ok).alias("fp"), total("bad", ~ok).alias("tn"), total("good", ~ok).alias("fn"))
    return confusion_rates(out)


def confusion_rates(df: DataFrame) -> DataFrame:
    """Rates from the columns tp, fp, tn and fn; null where a denominator is 0."""
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    n = tp + fp + tn + fn

    def share(a: Column, b: Column) -> Column:
        return F.try_divide(a.cast("double"), b.cast("double"))

    return df.withColumns({
        "precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "specificity": share(tn, tn + fp), "accuracy": share(tp + tn, n),
        "approval_rate": share(tp + fp, n), "bad_rate": share(fp, tp + fp), "f1": share(2 * tp, 2 * tp + fp + fn)})


def decile_table(df: DataFrame, label: str, score: str, bins: int = 10, by: list[str] | None = None) -> DataFrame:
    """Quantile bins of a risk score, 1 the riskiest: counts, rates, cumulated shares, KS and lift.

    Adds ``monotonic``: the bad rate never rises from one bin to the next.
    """
    by = by or []
    rows = df.where(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    edges = quantile_edges(rows, [score], bins)[score]
    binned = rows.withColumn("bin", len(edges) - 1 - bin_of(F.col(score), edges))
    t = binned.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"), F.min(score).alias("least"), F.max(score).alias("most"))
    t = t.withColumn("good", F.col("n") - F.col("bad")).withColumn("bad_rate", F.col("bad") / F.col("n"))
    run = Window.partitionBy(*by).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    out = t.withColumns({
        "cum_bad": F.sum("bad").over(run) / F.sum("bad").over(whole), "cum_good": F.sum("good").over(run) / F.sum("good").over(whole),
        "cum_n": F.sum("n").over(run) / F.sum("n").over(whole)})
    previous = F.lag("bad_rate").over(Window.partitionBy(*by).orderBy("bin"))
    out = out.withColumns({
        "ks": F.abs(F.col("cum_bad") - F.col("cum_good")),
        "lift": F.col("bad_rate") / (F.sum("bad").over(whole) / F.sum("n").over(whole)), "_falls": F.coalesce(F.col("bad_rate") <= previous, F.lit(True))})
    return out.withColumn("monotonic", F.min("_falls").over(whole)).drop("_falls")


def gain_lift(df: DataFrame, label: str, score: str, key: str, slices: int = 10) -> DataFrame:
    """Slices of n // slices rows from the riskiest on, the last with the rest: gain and lift."""
    rows = df.where(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    n = rows.count()
    size = max(n // slices, 1)
    rows, up_to = among_first(rows, score, key, [size * i for i in range(1, slices)], n)
    t = rows.groupBy(slice_of(up_to).alias("slice")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"))
    run, whole = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    out = t.withColumns({
        "gain": F.sum("bad").over(run) / F.sum("bad").over(whole), "population": F.sum("n").over(run) / F.sum("n").over(whole)})
    return out.withColumns({"lift": F.col("gain") / F.col("population"), "bad_rate": F.col("bad") / F.col("n"), "slice": (F.col("slice") + 1).cast("int")})


def calibration(df: DataFrame, label: str, prob: str, bins: int = 10, by: list[str] | None = None) -> DataFrame:
    """Equal-width bins of a probability: mean, observed rate and gap."""
    rows = df.where(F.col(label).isin(0, 1) & F.col(prob).isNotNull())
    b = F.least(F.floor(F.col(prob) * bins), F.lit(bins - 1)).cast("int")
    out = rows.groupBy(*(by or []), b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_prob"), F.avg(label).alias("rate"))
    return out.withColumn("gap", F.col("rate") - F.col("mean_prob"))


def calibration_by_quantile(df: DataFrame, label: str, prob: str, bins: int = 10) -> DataFrame:
    rows = df.where(F.col(label).isin(0, 1) & F.col(prob).isNotNull())
    edges = quantile_edges(rows, [prob], bins)[prob]
    out = rows.groupBy(bin_of(F.col(prob), edges).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(prob).alias("mean_prob"), F.avg(label).alias("rate"))
    return out.withColumn("gap", F.col("rate") - F.col("mean_prob"))


def expected_calibration_error(df: DataFrame, label: str, prob: str, bins: int = 10, by: list[str] | None = None) -> DataFrame:
    c = calibration(df, label, prob, bins, by)
    return c.groupBy(*(by or [])).agg((F.sum(F.col("n") * F.abs("gap")) / F.sum("n")).alias("ece"), F.max(F.abs("gap")).alias("max_gap"))


def brier(df: DataFrame, label: str, prob: str, bins: int = 10) -> DataFrame:
    """Brier score and its reliability, resolution, uncertainty and skill over equal-width bins."""
    rows = df.where(F.col(label).isin(0, 1) & F.col(prob).isNotNull())
    b = F.least(F.floor(F.col(prob) * bins), F.lit(bins - 1))
    t = rows.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(prob).alias("sp"), F.sum(label).alias("sy"), F.sum((F.col(prob) - F.col(label)) ** 2).alias("sq"))
    n, y = F.sum("n").over(Window.partitionBy()), F.sum("sy").over(Window.partitionBy())
    t = t.withColumn("base", y / n).withColumn("mean_prob", F.col("sp") / F.col("n")).withColumn("rate", F.col("sy") / F.col("n"))
    w = F.col("n") / F.sum("n").over(Window.partitionBy())
    t = t.withColumns({"rel": w * (F.col("mean_prob") - F.col("rate")) ** 2, "res": w * (F.col("rate") - F.col("base")) ** 2})
    out = t.agg((F.sum("sq") / F.sum("n")).alias("brier"), F.sum("rel").alias("reliability"), F.sum("res").alias("resolution"),
                F.first("base").alias("base_rate"))
    out = out.withColumn("uncertainty", F.col("base_rate") * (1 - F.col("base_rate")))
    return out.withColumn("skill", 1 - F.col("brier") / F.col("uncertainty"))


def error_segments(df: DataFrame, label: str, prob: str, threshold: float, by: list[str]) -> DataFrame:
    """Counts of TP, FP, TN and FN (positive: called bad) by group, a column each."""
    called = F.col(prob) >= threshold
    kind = F.when(called & (F.col(label) == 1), "tp").when(called, "fp").when(F.col(label) == 1, "fn").otherwise("tn")
    rows = df.where(F.col(label).isin(0, 1)).withColumn("kind", kind)
    return rows.groupBy(*by).pivot("kind", ["tp", "fp", "tn", "fn"]).count().na.fill(0, ["tp", "fp", "tn", "fn"])


def split_comparison(df: DataFrame, label: str, score: str, split: str, train: str) -> DataFrame:
    """Metrics by split with the gap and ratio of each split's KS to the training one."""
    m = ranking_metrics(df, label, score, [split])
    base = F.max(F.when(F.col(split) == train, F.col("ks"))).over(Window.partitionBy())
    return m.withColumns({"ks_gap": base - F.col("ks"), "ks_ratio": F.col("ks") / base})


def quality_gate(metrics: DataFrame, ks: float = 0.20, auc: float = 0.65, gini: float = 30.0, psi: float = 0.25) -> DataFrame:
    """Whether each row of metrics passes the minimum quality; a null fails."""
    ok = {"ks_ok": F.col("ks") > ks, "auc_ok": F.col("auc") > auc, "gini_ok": F.col("gini") > gini}
    if "psi" in metrics.columns:
        ok["psi_ok"] = F.col("psi") < psi
    out = metrics.withColumns({k: F.coalesce(v, F.lit(False)) for k, v in ok.items()})
    passed = F.lit(True)
    for k in ok:
        passed = passed & F.col(k)
    return out.withColumn("passed", passed)


def parity(found: DataFrame, expected: DataFrame, tolerances: dict[str, float]) -> DataFrame:
    """(metric, value) against (metric, value): difference, tolerance and status.

    Where one side is in percent and the other a share (one above 2, the other
    not) the percent is brought down. A metric that is missing fails.
    """
    a, b = found.select("metric", F.col("value").alias("found")), expected.select("metric", F.col("value").alias("expected"))
    both = b.join(a, "metric", "left")
    scaled = F.when((F.abs("found") > 2) & (F.abs("expected") <= 2), F.col("found") / 100).when(
        (F.abs("found") <= 2) & (F.abs("expected") > 2), F.col("found") * 100).otherwise(F.col("found"))
    limit = F.coalesce(*(F.when(F.col("metric") == m, F.lit(float(t))) for m, t in tolerances.items()))
    out = both.withColumn("found", scaled).withColumn("difference", F.abs(F.col("found") - F.col("expected"))).withColumn("tolerance", limit)
    return out.withColumn("status", F.when(F.coalesce(F.col("difference") <= F.col("tolerance"), F.lit(False)), "PASS").otherwise("FAIL"))


def score_correlation(df: DataFrame, scores: list[str], limit: float = 0.98) -> DataFrame:
    """Correlation of each pair of score columns, in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(scores) for b in scores[i + 1:]]
    one = df.agg(*(F.corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("correlation")) for i, (a, b) in enumerate(pairs)))
    return one.select(F.explode(rows).alias("x")).select("x.*").withColumn("redundant", F.col("correlation") > limit)


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two category columns, from their crosstab."""
    t = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).count()
    rows = t.groupBy("a").agg(F.sum("count").alias("ra")).join(t.groupBy(F.col("b").alias("a")).agg(F.sum("count").alias("cb")), "a", "full")
    chance = rows.agg(F.sum(F.coalesce("ra", F.lit(0)) * F.coalesce("cb", F.lit(0))).alias("chance"))
    seen = t.agg(F.sum("count").alias("n"), F.sum(F.when(F.col("a") == F.col("b"), F.col("count")).otherwise(0)).alias("same"))
    po, pe = F.col("same") / F.col("n"), F.col("chance") / (F.col("n") * F.col("n"))
    # one row each
    return seen.join(F.broadcast(chance)).select("n", po.alias("agreement"), ((po - pe) / (1 - pe)).alias("kappa"))


def disagreement(df: DataFrame, scores: list[str], top: float = 0.95) -> DataFrame:
    """Rows with the spread of their scores; the highest ones by standard deviation flagged."""
    a = F.array(*(F.col(s).cast("double") for s in scores))
    n = float(len(scores))
    mean = F.aggregate(a, F.lit(0.0), lambda x, y: x + y) / n
    rows = df.withColumn("_a", a).withColumn("_mean", mean).withColumns({
        "score_range": F.array_max("_a") - F.array_min("_a"),
        "score_std": F.sqrt(F.aggregate(F.transform("_a", lambda x: (x - F.col("_mean")) ** 2), F.lit(0.0), lambda x, y: x + y) / n)})
    limit = exact_quantiles(rows, {"score_std": F.col("score_std")}, [top]).agg(F.max(F.col("quantiles")[0]).alias("limit"))  # one row
    return rows.join(F.broadcast(limit)).withColumn("disputed", F.col("score_std") > F.col("limit")).drop("_a", "_mean", "limit")


def agreement_rate(df: DataFrame, a: str, b: str, threshold: float = 0.5, by: list[str] | None = None) -> DataFrame:
    same = (F.col(a) >= threshold) == (F.col(b) >= threshold)
    return df.groupBy(*(by or [])).agg(F.avg(same.cast("double")).alias("agreement"), F.count(F.lit(1)).alias("n"))


def approval_curve(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Approving the safest first (low risk score): approval rate, bad rate and captured bad by threshold."""
    c = curve(df, label, score, by)
    bad, good = F.col("before_bad") + F.col("bad"), F.col("before_good") + F.col("good")
    total = F.col("total_bad") + F.col("total_good")
    return c.select(*(by or []), F.col("score").alias("threshold"), ((bad + good) / total).alias("approval_rate"),
                    (bad / (bad + good)).alias("bad_rate"), (1 - bad / F.col("total_bad")).alias("bad_avoided"))


def probability_bands(df: DataFrame, label: str, prob: str, edges: list[float] | None = None) -> DataFrame:
    """Right-closed bands of a probability with counts and rates."""
    edges = edges or [0.0, 0.1, 0.2, 0.3, 0.5, 1.0]
    rows = df.where(F.col(prob).between(edges[0], edges[-1]) & F.col(label).isin(0, 1))
    return rows.groupBy(bin_of(F.col(prob), edges).alias("band")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"), F.avg(label).alias("rate")).withColumns({
            "low": F.element_at(F.array(*map(F.lit, edges)), F.col("band") + 1), "high": F.element_at(F.array(*map(F.lit, edges)), F.col("band") + 2)})


def band_contingency(df: DataFrame, label: str, band: str) -> DataFrame:
    """Counts and bad rate by risk band."""
    return df.where(F.col(label).isin(0, 1)).groupBy(band).agg(
        F.count(F.lit(1)).alias("n"), F.sum(label).alias("bad"), F.count_if(F.col(label) == 0).alias("good"), F.avg(label).alias("bad_rate"))


def capture_curve(df: DataFrame, label: str, score: str, key: str, shares: list[float]) -> DataFrame:
    """Bad rows captured in the riskiest shares of the population."""
    rows = df.where(F.col(label).isin(0, 1) & F.col(score).isNotNull())
    n = rows.count()
    rows, up_to = among_first(rows, score, key, [math.floor(n * s) for s in shares], n)
    found = F.array(*(F.struct(F.lit(s).alias("share"), F.count_if(x).alias("n_top"), F.sum(F.when(x, F.col(label)).otherwise(0)).alias("bad_top")) for s, x in zip(shares, up_to)))
    out = rows.agg(found.alias("_x"), F.sum(label).alias("_all"), F.count(F.lit(1)).alias("_n")).where("_n > 0").select(F.explode("_x").alias("_x"), "_all")
    return out.select("_x.*", "_all").withColumn("captured", F.col("bad_top") / F.col("_all")).drop("_all")
