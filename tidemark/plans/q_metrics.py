"""Metric, binning and stability queries over scored line items.

The label is a returned line, the risk scores are discount and quantity (with
heavy ties), the snapshot is the shipping year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import binning, metrics
from tidemark.plans.registry import Tables, query, rounded, shown

SCORED = """select ((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber as rid, l_discount * 10 as p1, l_quantity / 50 as p2, l_extendedprice as price, l_tax as tax,
    l_quantity as quantity, case when l_returnflag = 'R' then 1 else 0 end as label, cast(year(l_shipdate) as bigint) as yr,
    l_returnflag as flag, l_linestatus as status from lineitem"""


def scored(t: Tables) -> DataFrame:
    return t("lineitem").selectExpr(
        "((l_orderkey * 100000 + l_partkey) * 10000 + l_suppkey) * 10 + l_linenumber as rid", "l_discount * 10 as p1", "l_quantity / 50 as p2", "l_extendedprice as price", "l_tax as tax",
        "l_quantity as quantity", "case when l_returnflag = 'R' then 1 else 0 end as label", "cast(year(l_shipdate) as bigint) as yr",
        "l_returnflag as flag", "l_linestatus as status")


def curve_sql(score: str = "p2", by: str = "") -> str:
    g, over = (f"{by}, ", f"partition by {by} ") if by else ("", "")
    return f"""select *, coalesce(sum(bad) over ({over}order by score rows between unbounded preceding and 1 preceding), 0) as before_bad,
      coalesce(sum(good) over ({over}order by score rows between unbounded preceding and 1 preceding), 0) as before_good,
      sum(bad) over ({over}) as total_bad, sum(good) over ({over}) as total_good
      from (select {g}{score} as score, count(*) filter (where label = 1) as bad, count(*) filter (where label = 0) as good from ({SCORED}) group by all)"""


def ranking_sql(score: str = "p2", by: str = "") -> str:
    g = f"{by}, " if by else ""
    return f"""select *, (2 * auc - 1) * 100 as gini from (select {g}sum(bad) + sum(good) as n, sum(bad) as n_bad, sum(bad) / (sum(bad) + sum(good)) as bad_rate,
      max(abs((before_bad + bad) / total_bad - (before_good + good) / total_good)) as ks,
      sum(bad * (before_good + good / 2)) / max(total_bad) / max(total_good) as auc from ({curve_sql(score, by)}) group by all)"""


def edges_sql(column: str, bins: int, where: str = "true") -> str:
    levels = ", ".join(str(i / bins) for i in range(bins + 1))
    return f"(select list_sort(list_distinct(quantile_cont({column}, [{levels}]))) from ({SCORED}) where {where})"


def bin_sql(column: str, edges: str, test: str = ">") -> str:
    """Bin number from a list of edges in a column."""
    return f"len(list_filter(list_slice({edges}, 2, len({edges}) - 1), lambda e: {column} {test} e))"


NUMBERS = {"n": "i", "n_bad": "i", "bad_rate": "d", "ks": "d", "auc": "d", "gini": "d"}


@query(shown(ranking_sql(), **NUMBERS))
def metrics_ranking(t: Tables) -> DataFrame:
    return rounded(metrics.ranking_metrics(scored(t), "label", "p2"))


@query(shown(ranking_sql("price"), **NUMBERS))
def metrics_ranking_continuous(t: Tables) -> DataFrame:
    return rounded(metrics.ranking_metrics(scored(t), "label", "price"))


@query(shown(ranking_sql("p1", "yr"), yr="i", **NUMBERS))
def metrics_by_snapshot(t: Tables) -> DataFrame:
    return rounded(metrics.ranking_metrics(scored(t), "label", "p1", ["yr"], min_rows=100))


ROC = f"""select score as threshold, (total_bad - before_bad) / total_bad as tpr, (total_good - before_good) / total_good as fpr,
    (total_bad - before_bad) / (total_bad - before_bad + total_good - before_good) as precision from ({curve_sql()})"""


@query(shown(ROC, threshold="d", tpr="d", fpr="d", precision="d"))
def metrics_roc_points(t: Tables) -> DataFrame:
    return rounded(metrics.roc_points(scored(t), "label", "p2"))


@query(shown(f"select *, 2 * precision * tpr / (precision + tpr) as f1 from (select *, tpr - fpr as youden from ({ROC}) order by tpr - fpr desc, threshold limit 1)",
             threshold="d", tpr="d", fpr="d", precision="d", youden="d", f1="d"))
def metrics_best_threshold(t: Tables) -> DataFrame:
    return rounded(metrics.best_threshold(scored(t), "label", "p2"))


CUTOFFS = [300, 400, 500, 600, 700]
SAFE = f"select *, cast(floor((1 - p2) * 1000) as bigint) as safe from ({SCORED})"
CONFUSION = f"""select *, tp / nullif(tp + fp, 0) as precision, tp / nullif(tp + fn, 0) as recall, tn / nullif(tn + fp, 0) as specificity,
    (tp + tn) / (tp + fp + tn + fn) as accuracy, (tp + fp) / (tp + fp + tn + fn) as approval_rate, fp / nullif(tp + fp, 0) as bad_rate,
    2 * tp / nullif(2 * tp + fp + fn, 0) as f1 from (select cutoff, count(*) filter (where safe >= cutoff and label = 0) as tp,
    count(*) filter (where safe >= cutoff and label = 1) as fp, count(*) filter (where safe < cutoff and label = 1) as tn,
    count(*) filter (where safe < cutoff and label = 0) as fn from ({SAFE}), (select unnest({CUTOFFS}) as cutoff) group by cutoff)"""
RATES = dict.fromkeys(("precision", "recall", "specificity", "accuracy", "approval_rate", "bad_rate", "f1"), "d")


@query(shown(CONFUSION, cutoff="d", tp="i", fp="i", tn="i", fn="i", **RATES))
def metrics_confusion_at_cutoffs(t: Tables) -> DataFrame:
    return rounded(metrics.confusion_at(scored(t).withColumn("safe", F.floor((1 - F.col("p2")) * 1000)), "label", "safe", CUTOFFS))


DECILES = f"""select *, abs(cum_bad - cum_good) as ks, bad_rate / (sum(bad) over () / sum(n) over ()) as lift,
    case when min(falls) over () = 1 then 'true' else 'false' end as monotonic from (select *, sum(bad) over w / sum(bad) over () as cum_bad, sum(good) over w / sum(good) over () as cum_good,
    sum(n) over w / sum(n) over () as cum_n, case when bad_rate <= coalesce(lag(bad_rate) over (order by bin), 9) then 1 else 0 end as falls
    from (select bin, count(*) as n, sum(label) as bad, count(*) - sum(label) as good, sum(label) / count(*) as bad_rate, min(price) as least, max(price) as most
      from (select *, len(e) - 1 - {bin_sql('price', 'e')} as bin from ({SCORED}), (select {edges_sql('price', 10)} as e)) group by bin)
    window w as (order by bin rows between unbounded preceding and current row))"""


@query(shown(DECILES, bin="i", n="i", bad="i", good="i", least="d", most="d", bad_rate="d", cum_bad="d", cum_good="d", cum_n="d", ks="d", lift="d", monotonic="s"))
def metrics_decile_table(t: Tables) -> DataFrame:
    d = metrics.decile_table(scored(t), "label", "price")
    return rounded(d.withColumn("monotonic", F.col("monotonic").cast("string")))


RANKED = f"select *, row_number() over (order by p2 desc, rid) as rank, count(*) over () as n_rows from ({SCORED})"


@query(shown(f"""select *, gain / population as lift, bad / n as bad_rate from (select slice, n, bad, sum(bad) over w / sum(bad) over () as gain, sum(n) over w / sum(n) over () as population
    from (select least((rank - 1) // (n_rows // 10), 9) + 1 as slice, count(*) as n, sum(label) as bad from ({RANKED}) group by 1)
    window w as (order by slice rows between unbounded preceding and current row))""",
             slice="i", n="i", bad="i", gain="d", population="d", lift="d", bad_rate="d"))
def metrics_gain_lift(t: Tables) -> DataFrame:
    return rounded(metrics.gain_lift(scored(t), "label", "p2", "rid"))


CALIBRATION = f"""select bin, count(*) as n, avg(p1) as mean_prob, avg(label) as rate, avg(label) - avg(p1) as gap
    from (select *, least(cast(floor(p1 * 10) as bigint), 9) as bin from ({SCORED})) group by bin"""


@query(shown(CALIBRATION, bin="i", n="i", mean_prob="d", rate="d", gap="d"))
def metrics_calibration(t: Tables) -> DataFrame:
    return rounded(metrics.calibration(scored(t), "label", "p1"))


@query(shown(f"""select bin, count(*) as n, avg(p2) as mean_prob, avg(label) as rate, avg(label) - avg(p2) as gap
    from (select *, {bin_sql('p2', 'e')} as bin from ({SCORED}), (select {edges_sql('p2', 10)} as e)) group by bin""", bin="i", n="i", mean_prob="d", rate="d", gap="d"))
def metrics_calibration_by_quantile(t: Tables) -> DataFrame:
    return rounded(metrics.calibration_by_quantile(scored(t), "label", "p2"))


@query(shown(f"select sum(n * abs(gap)) / sum(n) as ece, max(abs(gap)) as max_gap from ({CALIBRATION})", ece="d", max_gap="d"))
def metrics_expected_calibration_error(t: Tables) -> DataFrame:
    return rounded(metrics.expected_calibration_error(scored(t), "label", "p1"))


@query(shown(f"""select *, base_rate * (1 - base_rate) as uncertainty, 1 - brier / (base_rate * (1 - base_rate)) as skill from (
    select (select avg((p1 - label) * (p1 - label)) from ({SCORED})) as brier, sum(n / tot * (mean_prob - rate) * (mean_prob - rate)) as reliability,
    sum(n / tot * (rate - base) * (rate - base)) as resolution, max(base) as base_rate
    from ({CALIBRATION}), (select avg(label) as base, count(*) as tot from ({SCORED})))""",
             brier="d", reliability="d", resolution="d", base_rate="d", uncertainty="d", skill="d"))
def metrics_brier(t: Tables) -> DataFrame:
    return rounded(metrics.brier(scored(t), "label", "p1"))


@query(shown(f"""select yr, status, count(*) filter (where p2 >= 0.5 and label = 1) as tp, count(*) filter (where p2 >= 0.5 and label = 0) as fp,
    count(*) filter (where p2 < 0.5 and label = 0) as tn, count(*) filter (where p2 < 0.5 and label = 1) as fn from ({SCORED}) group by yr, status""",
             yr="i", status="s", tp="i", fp="i", tn="i", fn="i"))
def metrics_error_segments(t: Tables) -> DataFrame:
    return rounded(metrics.error_segments(scored(t), "label", "p2", 0.5, ["yr", "status"]))


SPLIT = "case when yr <= 1998 then 'train' when yr <= 2000 then 'oos' else 'oot' end"


@query(shown(f"select *, max(ks) filter (where split = 'train') over () - ks as ks_gap, ks / max(ks) filter (where split = 'train') over () as ks_ratio from ({ranking_sql('p2', SPLIT + ' as split').replace('partition by ' + SPLIT + ' as split', 'partition by split').replace('select ' + SPLIT + ' as split, sum(bad)', 'select split, sum(bad)')})",
             split="s", **NUMBERS, ks_gap="d", ks_ratio="d"))
def metrics_split_comparison(t: Tables) -> DataFrame:
    return rounded(metrics.split_comparison(scored(t).withColumn("split", F.expr(SPLIT)), "label", "p2", "split", "train"))


@query(f"select yr, coalesce(ks > 0.2, false) as ks_ok, coalesce(auc > 0.65, false) as auc_ok, coalesce(gini > 30, false) as gini_ok, coalesce(ks > 0.2 and auc > 0.65 and gini > 30, false) as passed from ({ranking_sql('p2', 'yr')})")
def metrics_quality_gate(t: Tables) -> DataFrame:
    return metrics.quality_gate(metrics.ranking_metrics(scored(t), "label", "p2", ["yr"])).select("yr", "ks_ok", "auc_ok", "gini_ok", "passed")


@query(shown(f"""select a, b, correlation, case when correlation > 0.98 then 'true' else 'false' end as redundant from (
    select 'p1' as a, 'p2' as b, corr(p1, p2) as correlation from ({SCORED}) union all select 'p1', 'quantity', corr(p1, quantity) from ({SCORED})
    union all select 'p2', 'quantity', corr(p2, quantity) from ({SCORED}))""", a="s", b="s", correlation="d", redundant="s"))
def metrics_score_correlation(t: Tables) -> DataFrame:
    out = metrics.score_correlation(scored(t), ["p1", "p2", "quantity"])
    return rounded(out.withColumn("redundant", F.col("redundant").cast("string")))


BANDS2 = "cast(least(floor(p1 * 10), 9) as bigint) as a, cast(least(floor(p2 * 10), 9) as bigint) as b"


@query(shown(f"""select n, same / n as agreement, (same / n - chance / (n * n)) / (1 - chance / (n * n)) as kappa from (select count(*) as n, cast(count(*) filter (where a = b) as double) as same
    from (select {BANDS2} from ({SCORED}))), (select cast(sum(ra * cb) as double) as chance from (select a, count(*) as ra from (select {BANDS2} from ({SCORED})) group by a)
    join (select b, count(*) as cb from (select {BANDS2} from ({SCORED})) group by b) on a = b)""", n="i", agreement="d", kappa="d"))
def metrics_kappa(t: Tables) -> DataFrame:
    bands = [F.least(F.floor(F.col(p) * 10), F.lit(9)).alias(c) for p, c in (("p1", "a"), ("p2", "b"))]
    return rounded(metrics.kappa(scored(t).select(*bands), "a", "b"))


@query(shown(f"""select flag, avg(abs(p1 - p2)) as spread, avg(abs(p1 - p2) / 2) as std, count(*) filter (where abs(p1 - p2) / 2 > lim + 1e-9) as disputed from ({SCORED}),
    (select quantile_cont(abs(p1 - p2) / 2, 0.95) as lim from ({SCORED})) group by flag""", flag="s", spread="d", std="d", disputed="i"))
def metrics_disagreement(t: Tables) -> DataFrame:
    d = metrics.disagreement(scored(t), ["p1", "p2"])
    limit = d.where(~F.col("disputed")).agg(F.max("score_std").alias("top"))
    return rounded(d.join(F.broadcast(limit)).groupBy("flag").agg(
        F.avg("score_range").alias("spread"), F.avg("score_std").alias("std"), F.count_if(F.col("score_std") > F.col("top") + 1e-9).alias("disputed")))


@query(shown(f"select yr, avg(case when (p1 >= 0.5) = (p2 >= 0.5) then 1.0 else 0.0 end) as agreement, count(*) as n from ({SCORED}) group by yr", yr="i", agreement="d", n="i"))
def metrics_agreement_rate(t: Tables) -> DataFrame:
    return rounded(metrics.agreement_rate(scored(t), "p1", "p2", 0.5, ["yr"]))


@query(shown(f"""select score as threshold, (before_bad + bad + before_good + good) / (total_bad + total_good) as approval_rate,
    (before_bad + bad) / (before_bad + bad + before_good + good) as bad_rate, 1 - (before_bad + bad) / total_bad as bad_avoided from ({curve_sql()})""",
             threshold="d", approval_rate="d", bad_rate="d", bad_avoided="d"))
def metrics_approval_curve(t: Tables) -> DataFrame:
    return rounded(metrics.approval_curve(scored(t), "label", "p2"))


@query(shown(f"""select band, n, bad, rate, list_extract([0.0, 0.1, 0.2, 0.3, 0.5], band + 1) as low, list_extract([0.1, 0.2, 0.3, 0.5, 1.0], band + 1) as high from (
    select case when p2 > 0.5 then 4 when p2 > 0.3 then 3 when p2 > 0.2 then 2 when p2 > 0.1 then 1 else 0 end as band, count(*) as n, sum(label) as bad, avg(label) as rate
    from ({SCORED}) group by 1)""", band="i", n="i", bad="i", rate="d", low="d", high="d"))
def metrics_probability_bands(t: Tables) -> DataFrame:
    return rounded(metrics.probability_bands(scored(t), "label", "p2"))


@query(shown(f"select status, count(*) as n, sum(label) as bad, count(*) filter (where label = 0) as good, avg(label) as bad_rate from ({SCORED}) group by status",
             status="s", n="i", bad="i", good="i", bad_rate="d"))
def metrics_band_contingency(t: Tables) -> DataFrame:
    return rounded(metrics.band_contingency(scored(t), "label", "status"))


@query(shown(f"""select share, count(*) filter (where rank <= floor(n_rows * share)) as n_top, coalesce(sum(label) filter (where rank <= floor(n_rows * share)), 0) as bad_top,
    coalesce(sum(label) filter (where rank <= floor(n_rows * share)), 0) / sum(label) as captured from ({RANKED}), (select unnest([0.05, 0.1, 0.2, 0.3]) as share) group by share""",
             share="d", n_top="i", bad_top="i", captured="d"))
def metrics_capture_curve(t: Tables) -> DataFrame:
    return rounded(metrics.capture_curve(scored(t), "label", "p2", "rid", [0.05, 0.1, 0.2, 0.3]))


@query(shown(f"""select metric, value as found, expected, abs(value - expected) as difference, tol as tolerance, case when abs(value - expected) <= tol then 'PASS' else 'FAIL' end as status from (
    select 'ks' as metric, ks as value, 0.01 as expected, 0.03 as tol from ({ranking_sql()}) union all select 'auc', auc, 0.6, 0.02 from ({ranking_sql()})
    union all select 'psi', null, 0.1, 0.1)""", metric="s", found="d", expected="d", difference="d", tolerance="d", status="s"))
def metrics_parity(t: Tables) -> DataFrame:
    m = metrics.ranking_metrics(scored(t), "label", "p2").selectExpr("stack(2, 'ks', ks, 'auc', auc) as (metric, value)")
    expected = m.sparkSession.createDataFrame([("ks", 0.01), ("auc", 0.6), ("psi", 0.1)], "metric string, value double")
    return rounded(metrics.parity(m, expected, {"ks": 0.03, "auc": 0.02, "psi": 0.1}))


# ---- binning, IV, PSI -----------------------------------------------------------

FEATURES = ["p1", "p2", "price", "tax"]


def woe_sql(add: float, more: str, clip: bool = False) -> str:
    parts = " union all ".join(
        f"select '{c}' as feature, {bin_sql(c, 'e')} as bin, label from ({SCORED}), (select {edges_sql(c, 10)} as e)" for c in FEATURES)
    counts = f"select feature, bin, count(*) as n, count(*) filter (where label = 1) as bad, count(*) filter (where label = 0) as good from ({parts}) group by feature, bin"
    b, g = (f"({x} + {add}) / (sum({x}) over w + {more})" for x in ("bad", "good"))
    if clip:
        b, g = f"greatest({b}, 1e-4)", f"greatest({g}, 1e-4)"
    return f"select feature, bin, n, bad, good, ln(g / b) as woe, (g - b) * ln(g / b) as iv from (select *, {b} as b, {g} as g from ({counts}) window w as (partition by feature))"


WOE = {"feature": "s", "bin": "i", "n": "i", "bad": "i", "good": "i", "woe": "d", "iv": "d"}


@query(shown(woe_sql(0.5, "0.5 * count(*) over w"), **WOE))
def binning_woe_table(t: Tables) -> DataFrame:
    return rounded(binning.woe_table(scored(t), FEATURES, "label"))


@query(shown(woe_sql(0.5, "1"), **WOE))
def binning_woe_table_one(t: Tables) -> DataFrame:
    return rounded(binning.woe_table(scored(t), FEATURES, "label", smoothing="one"))


@query(shown(woe_sql(0, "0", clip=True), **WOE))
def binning_woe_table_clipped(t: Tables) -> DataFrame:
    return rounded(binning.woe_table(scored(t), FEATURES, "label", smoothing="clip"))


STRENGTH = "case when iv >= 0.5 then 'very strong' when iv >= 0.3 then 'strong' when iv >= 0.1 then 'medium' when iv >= 0.02 then 'weak' else 'none' end"
IV = f"select feature, round(sum(iv), 6) as iv from ({woe_sql(0.5, '0.5 * count(*) over w')}) group by feature"


@query(shown(f"select *, {STRENGTH} as strength from ({IV})", feature="s", iv="d", strength="s"))
def binning_information_value(t: Tables) -> DataFrame:
    return rounded(binning.information_value(scored(t), FEATURES, "label"))


@query(shown(f"select bin, count(*) as n, min(price) as least, max(price) as most from (select *, {bin_sql('price', 'e')} as bin from ({SCORED}), (select {edges_sql('price', 4)} as e)) group by bin",
             bin="i", n="i", least="d", most="d"))
def binning_quantile_bins(t: Tables) -> DataFrame:
    s = scored(t)
    edges = binning.quantile_edges(s, ["price"], 4)["price"]
    return rounded(s.groupBy(binning.bin_of(F.col("price"), edges).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.min("price").alias("least"), F.max("price").alias("most")))


@query(shown(f"""select flag, sum(woe_p2) as total from (select flag, ({woe_sql(0.5, '0.5 * count(*) over w').join(('select max(woe) from (', ')'))} where feature = 'p2' and bin = s.bin) as woe_p2
    from (select *, {bin_sql('p2', 'e')} as bin from ({SCORED}), (select {edges_sql('p2', 10)} as e)) s) group by flag""", flag="s", total="d"))
def features_woe_encode(t: Tables) -> DataFrame:
    return rounded(binning.woe_encode(scored(t), "p2", "label").groupBy("flag").agg(F.sum("woe_p2").alias("total")))


def psi_sql(features: list[str], expected: str, actual: str, by: str = "", clip: bool = False, edges: str | None = None) -> str:
    g = f"{by}, " if by else ""
    numbered = " union all ".join(
        f"select '{c}' as feature, {bin_sql(c, 'e', '>=')} as bin, len(e) - 1 as k, * exclude (e) from ({SCORED}), (select {edges or edges_sql(c, 10, expected)} as e)" for c in features)
    pe, pa = ("greatest(n_e / te, 1e-4)", "greatest(n_a / ta, 1e-4)") if clip else ("(n_e + 1) / (te + k)", "(n_a + 1) / (ta + k)")
    groups = f"select distinct {g}feature, k from ({numbered}) where {actual}"
    e = f"select feature as f1, bin as b1, count(*) as n_e from ({numbered}) where {expected} group by all"
    a = f"select {by + ' as g2, ' if by else ''}feature as f2, bin as b2, count(*) as n_a from ({numbered}) where {actual} group by all"
    match = " and g2 = {0}".format(by) if by else ""
    full = f"""select {g}feature, k, bin, coalesce(n_e, 0) as n_e, coalesce(n_a, 0) as n_a, sum(coalesce(n_e, 0)) over w as te, sum(coalesce(n_a, 0)) over w as ta
      from (select *, unnest(range(k)) as bin from ({groups})) left join ({e}) on f1 = feature and b1 = bin left join ({a}) on f2 = feature and b2 = bin{match}
      window w as (partition by {g}feature)"""
    return f"select {g}feature, round(sum(({pa} - {pe}) * ln({pa} / {pe})), 6) as psi from ({full}) group by {g}feature"


@query(shown(psi_sql(FEATURES, "yr <= 1998", "yr > 1998"), feature="s", psi="d"))
def stability_psi(t: Tables) -> DataFrame:
    return rounded(binning.psi_table(scored(t), FEATURES, F.col("yr") <= 1998, F.col("yr") > 1998))


@query(shown(psi_sql(FEATURES, "yr <= 1998", "yr > 1998", "yr"), yr="i", feature="s", psi="d"))
def stability_psi_by_snapshot(t: Tables) -> DataFrame:
    return rounded(binning.psi_table(scored(t), FEATURES, F.col("yr") <= 1998, F.col("yr") > 1998, ["yr"]))


@query(shown(psi_sql(FEATURES, "yr <= 1998", "yr > 1998", clip=True), feature="s", psi="d"))
def stability_psi_clipped(t: Tables) -> DataFrame:
    return rounded(binning.psi_table(scored(t), FEATURES, F.col("yr") <= 1998, F.col("yr") > 1998, smoothing="clip"))


FIXED = "[" + ", ".join(str(e) for e in binning.equal_width_edges(0.0, 1.0, 10)) + "]"


@query(shown(psi_sql(["p1", "p2"], "yr <= 1998", "yr > 1998", edges=FIXED), feature="s", psi="d"))
def stability_psi_equal_width(t: Tables) -> DataFrame:
    edges = binning.equal_width_edges(0.0, 1.0, 10)
    return rounded(binning.psi_table(scored(t), ["p1", "p2"], F.col("yr") <= 1998, F.col("yr") > 1998, edges={"p1": edges, "p2": edges}))


@query(shown(f"select yr, feature, psi, case when psi < 0.1 then 'GREEN' when psi < 0.25 then 'YELLOW' else 'RED' end as alert from ({psi_sql(['p2'], 'yr <= 1998', 'yr > 1998', 'yr')})",
             yr="i", feature="s", psi="d", alert="s"))
def stability_psi_alert(t: Tables) -> DataFrame:
    p = binning.psi_table(scored(t), ["p2"], F.col("yr") <= 1998, F.col("yr") > 1998, ["yr"])
    return rounded(p.withColumn("alert", binning.psi_alert(F.col("psi"))))
