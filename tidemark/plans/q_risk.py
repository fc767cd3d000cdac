"""Scoring, decision and monitoring queries over scored line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators import decision, drift_states, monitoring, scoring, selection
from tidemark.operators.metrics import ranking_metrics
from tidemark.plans.q_metrics import CONFUSION, CUTOFFS, RANKED, SCORED, bin_sql, psi_sql, ranking_sql, scored
from tidemark.plans.registry import Tables, query, rounded, shown
from tidemark.sources.io import scratch_path

SCORE = "least(greatest(cast(trunc((1 - p2) * 1000) as bigint), 0), 1000)"
BAND = "case when {0} < 300 then 'CRITICO' when {0} < 500 then 'ALTO' when {0} < 700 then 'MEDIO' else 'BAIXO' end"

# ---- scoring ---------------------------------------------------------------------


@query(shown(f"""select rid, {SCORE} as score, {BAND.format(SCORE)} as band, round_even((1 - p2) * 1000, 0) as score_round,
    round_even(600 + 20 * log2((1 - p) / p / 50), 0) as points from (select *, least(greatest(p2, 1e-6), 1 - 1e-6) as p from ({SCORED}))""", rid="i", score="i", band="s", score_round="i", points="i"))
def scoring_scores(t: Tables) -> DataFrame:
    p = F.col("p2")
    return rounded(scored(t).select("rid", scoring.score_0_1000(p).alias("score"), scoring.risk_band(scoring.score_0_1000(p)).alias("band"),
                                    scoring.score_round(p).alias("score_round"), scoring.pdo_score(p).alias("points")))


@query(shown(f"""select rid, len(list_filter(list_distinct(e), lambda x: price > x)) + 1 as risk_class from ({SCORED}) join (
    select yr as y2, quantile_cont(price, [0.2, 0.4, 0.6, 0.8]) as e from ({SCORED}) group by yr) on y2 = yr""", rid="i", risk_class="i"))
def scoring_quantile_class(t: Tables) -> DataFrame:
    return rounded(scoring.quantile_class(scored(t), "price", 5, "yr").select("rid", "risk_class"))


@query(shown(" union all ".join(f"select '{c}' as feature, corr({c}, label) as coefficient, -corr({c}, label) * 50 / ln(2) as points, 600.0 as base from ({SCORED})" for c in ("p1", "p2", "price")),
             feature="s", coefficient="d", points="d", base="d"))
def scoring_scorecard_points(t: Tables) -> DataFrame:
    """Points of one-feature scorecards, with correlations as coefficients."""
    found = selection.label_correlations(scored(t), ["p1", "p2", "price"], "label")
    return rounded(scoring.scorecard_points(found.withColumnRenamed("correlation", "coefficient")))


@query(shown(f"select rid, {SCORE} as score, {BAND.format(SCORE)} as band, round(p2, 6) as prob, 'v1' as model_version from ({SCORED})", rid="i", score="i", band="s", prob="d", model_version="s"))
def scoring_batch_external(t: Tables) -> DataFrame:
    """A model from outside Spark scores by batches; here it returns its input."""
    out = scoring.batch_score_external(lambda x: x["p2"], scored(t), ["rid"], ["p2"], "v1", "run")
    return rounded(out.drop("scored_at", "execution_id"))


@query(f"""select "check", failures, failures = 0 as ok from (select 'out_of_range' as "check", count(*) filter (where {SCORE} not between 0 and 1000) as failures from ({SCORED})
    union all select 'missing', count(*) filter (where p2 is null) from ({SCORED}) union all select 'bad_probability', count(*) filter (where p2 not between 0 and 1) from ({SCORED})
    union all select 'repeated_keys', count(*) from (select rid from ({SCORED}) group by rid having count(*) > 1)
    union all select 'absent_snapshots', count(*) from (select unnest([1996, 1997, 2050]) as s) where s not in (select yr from ({SCORED})))""")
def scoring_validate(t: Tables) -> DataFrame:
    s = scored(t).withColumn("prob", F.col("p2")).withColumn("score", scoring.score_0_1000(F.col("p2")))
    return scoring.validate_scores(s, ["rid"], "yr", [1996, 1997, 2050])


@query(shown(f"""select yr, count(*) as n, avg(s) as mean, stddev_samp(s) as std, min(s) as least, quantile_cont(s, 0.25) as p25, quantile_cont(s, 0.5) as median, quantile_cont(s, 0.75) as p75, max(s) as most
    from (select yr, {SCORE} as s from ({SCORED})) group by yr""", yr="i", n="i", mean="d", std="d", least="d", p25="d", median="d", p75="d", most="d"))
def scoring_statistics(t: Tables) -> DataFrame:
    return rounded(scoring.score_statistics(scored(t).withColumn("s", scoring.score_0_1000(F.col("p2"))), "s", ["yr"]))


@query(shown(f"select yr, band, n, n * 100.0 / sum(n) over (partition by yr) as percent from (select yr, {BAND.format(SCORE)} as band, count(*) as n from ({SCORED}) group by all)", yr="i", band="s", n="i", percent="d"))
def scoring_band_distribution(t: Tables) -> DataFrame:
    s = scored(t).withColumn("band", scoring.risk_band(scoring.score_0_1000(F.col("p2"))))
    return rounded(scoring.band_distribution(s, "band", ["yr"]))


@query(f"select label, cast(least(floor(price / 2000) + 1, 50) as integer) as bin, count(*) as n from ({SCORED}) where price between 0 and 100000 group by all")
def scoring_histogram(t: Tables) -> DataFrame:
    """The bins of the range that the SQL defines, without those outside of it."""
    return scoring.score_histogram(scored(t), "price", 0.0, 100000.0, 50, ["label"]).where("bin between 1 and 50")


# ---- decisions ----------------------------------------------------------------------

PARTLY = f"select *, case when rid % 4 = 0 then null else label end as known, cast(floor((1 - p2) * 1000) as bigint) as safe, cast(floor((1 - p1) * 1000) as bigint) as old from ({SCORED})"


def partly(t: Tables) -> DataFrame:
    return scored(t).withColumns({"known": F.expr("case when rid % 4 = 0 then null else label end"), "safe": F.floor((1 - F.col("p2")) * 1000), "old": F.floor((1 - F.col("p1")) * 1000)})


@query(shown(f"""select yr, case when known is null then 'unlabeled' else 'labeled' end as population, count(*) as n, avg(p2) as mean, quantile_cont(p2, 0.5) as median, stddev_samp(p2) as std, avg(known) as bad_rate
    from ({PARTLY}) group by all""", yr="i", population="s", n="i", mean="d", median="d", std="d", bad_rate="d"))
def decision_labelled_comparison(t: Tables) -> DataFrame:
    return rounded(decision.labelled_comparison(partly(t), "known", "p2", ["yr"]))


@query(shown(psi_sql(["p2"], "rid % 4 <> 0", "rid % 4 = 0"), feature="s", psi="d"))
def decision_labelled_psi(t: Tables) -> DataFrame:
    return rounded(decision.labelled_psi(partly(t), "known", "p2"))


SWAPS = f"""select *, approved / n as approval_rate, bad_approved / nullif(approved, 0) as bad_rate, bad_in / nullif(swap_in, 0) as bad_rate_in, bad_out / nullif(swap_out, 0) as bad_rate_out, bad / n as overall_bad_rate from (
    select cutoff, count(*) as n, count(*) filter (where safe >= cutoff) as approved, count(*) filter (where safe >= cutoff and old < 500) as swap_in, count(*) filter (where safe < cutoff and old >= 500) as swap_out,
    coalesce(sum(known) filter (where safe >= cutoff), 0) as bad_approved, coalesce(sum(known) filter (where safe >= cutoff and old < 500), 0) as bad_in, coalesce(sum(known) filter (where safe < cutoff and old >= 500), 0) as bad_out, sum(known) as bad
    from ({PARTLY}), (select unnest({CUTOFFS}) as cutoff) where known is not null group by cutoff)"""
SWAP_FORMS = {"cutoff": "d", **dict.fromkeys(("n", "approved", "swap_in", "swap_out", "bad_approved", "bad_in", "bad_out", "bad"), "i"),
              **dict.fromkeys(("approval_rate", "bad_rate", "bad_rate_in", "bad_rate_out", "overall_bad_rate"), "d")}


@query(shown(SWAPS, **SWAP_FORMS))
def decision_swap_by_cutoff(t: Tables) -> DataFrame:
    return rounded(decision.swap_by_cutoff(partly(t), "known", "old", "safe", 500, CUTOFFS))


@query(f"""select cast(coalesce(a, b, c) as double) as cutoff, case when a is not null then 'bad rate and approval' when b is not null then 'least bad rate' else 'last' end as reason from (
    select max(cutoff) filter (where bad_rate <= 2 * overall_bad_rate and approval_rate >= 0.3) as a, min_by(cutoff, bad_rate) filter (where approval_rate >= 0.1) as b, max(cutoff) as c from ({SWAPS}))""")
def decision_recommend_cutoff(t: Tables) -> DataFrame:
    return decision.recommend_cutoff(decision.swap_by_cutoff(partly(t), "known", "old", "safe", 500, CUTOFFS))


@query(shown(f"select cutoff, count(*) as n, count(*) filter (where safe >= cutoff) as approved, count(*) filter (where safe >= cutoff) * 100.0 / count(*) as percent from ({PARTLY}), (select unnest({CUTOFFS}) as cutoff) where known is null group by cutoff",
             cutoff="d", n="i", approved="i", percent="d"))
def decision_unlabelled_projection(t: Tables) -> DataFrame:
    return rounded(decision.unlabelled_projection(partly(t), "known", "safe", CUTOFFS))


@query(shown(f"""select share, yr as period, max(cut) as cut, count(*) as n, count(*) filter (where price >= cut) as n_over, coalesce(sum(label) filter (where price >= cut), 0) as bad_over, sum(label) as bad,
    count(*) filter (where price >= cut) / count(*) as over_rate, sum(label) filter (where price >= cut) / count(*) filter (where price >= cut) as bad_rate_over, sum(label) filter (where price >= cut) / sum(label) as captured
    from ({SCORED}), (select unnest([0.05, 0.1, 0.2, 0.3]) as share, unnest(quantile_cont(price, [0.95, 0.9, 0.8, 0.7])) as cut from ({SCORED}) where yr = 1996) where yr in (1996, 1997) group by share, yr""",
             share="d", period="i", cut="d", n="i", n_over="i", bad_over="i", bad="i", over_rate="d", bad_rate_over="d", captured="d"))
def decision_cross_period_swap(t: Tables) -> DataFrame:
    return rounded(decision.cross_period_swap(scored(t), "yr", 1996, 1997, "label", "price", [0.05, 0.1, 0.2, 0.3]))


@query(shown(f"""select share, count(*) filter (where ra <= floor(n_rows * share)) as n_top, count(*) filter (where ra <= floor(n_rows * share) and rb <= floor(n_rows * share)) as overlap,
    count(*) filter (where ra <= floor(n_rows * share) and rb > floor(n_rows * share)) as swap_in, count(*) filter (where ra > floor(n_rows * share) and rb <= floor(n_rows * share)) as swap_out,
    sum(label) filter (where ra <= floor(n_rows * share)) / sum(label) as captured from (select *, row_number() over (order by p1 desc, rid) as ra, rank as rb from ({RANKED})), (select unnest([0.1, 0.3]) as share) group by share""",
             share="d", n_top="i", overlap="i", swap_in="i", swap_out="i", captured="d"))
def decision_ranking_overlap(t: Tables) -> DataFrame:
    return rounded(decision.ranking_overlap(scored(t), "label", "p1", "p2", "rid", [0.1, 0.3]))


@query(shown(f"""select yr, top_mean, bottom_mean, top_mean - lag(top_mean) over (order by yr) as top_change, bottom_mean - lag(bottom_mean) over (order by yr) as bottom_change from (
    select yr, avg(price) filter (where price >= hi) as top_mean, avg(price) filter (where price <= lo) as bottom_mean from ({SCORED}) join (
      select yr as y2, quantile_cont(price, 0.1) as lo, quantile_cont(price, 0.9) as hi from ({SCORED}) group by yr) on y2 = yr group by yr)""", yr="i", top_mean="d", bottom_mean="d", top_change="d", bottom_change="d"))
def decision_tail_shift(t: Tables) -> DataFrame:
    return rounded(decision.tail_shift(scored(t), "price", "yr"))


@query(shown(f"""select cutoff, tp, fp, tn, fn, tp * 10.0 as revenue, fp * 44.89 as loss, tn * 44.89 as avoided_loss, fn * 10.0 as lost_revenue, tp * 10.0 - fp * 44.89 as net,
    (tp + fn) * 10.0 - (fp + tn) * 44.89 as net_approve_all, tp * 10.0 - fp * 44.89 - ((tp + fn) * 10.0 - (fp + tn) * 44.89) as gain from ({CONFUSION})""",
             cutoff="d", tp="i", fp="i", tn="i", fn="i", revenue="d", loss="d", avoided_loss="d", lost_revenue="d", net="d", net_approve_all="d", gain="d"))
def decision_financial_impact(t: Tables) -> DataFrame:
    return rounded(decision.financial_impact(partly(t), "label", "safe", CUTOFFS))


@query(shown("select quantile_cont(l_extendedprice, 0.5) as lgd from lineitem where l_extendedprice > 0", lgd="d"))
def decision_median_open_value(t: Tables) -> DataFrame:
    return rounded(decision.median_open_value(t("lineitem"), "l_extendedprice"))


# ---- monitoring -----------------------------------------------------------------------

ALERT = "case when psi < 0.1 then 'GREEN' when psi < 0.25 then 'YELLOW' else 'RED' end"
TRAIN = [1995, 1996, 1997, 1998]


def late() -> Column:
    return F.col("yr") > 1998


@query(shown(f"select *, {ALERT} as alert from ({psi_sql(['p1'], 'yr <= 1998', 'yr > 1998', 'yr')})", yr="i", feature="s", psi="d", alert="s"))
def monitor_score_drift(t: Tables) -> DataFrame:
    return rounded(monitoring.score_drift(scored(t), "p1", "yr", TRAIN))


HEAT = f"select *, case when psi <= 0.1 then 'GREEN' when psi <= 0.2 then 'YELLOW' else 'RED' end as alert from ({psi_sql(['p1', 'p2', 'price', 'tax'], 'yr <= 1998', 'yr > 1998', 'yr')})"


@query(shown(HEAT, yr="i", feature="s", psi="d", alert="s"))
def monitor_feature_heat(t: Tables) -> DataFrame:
    return rounded(monitoring.feature_drift(scored(t), ["p1", "p2", "price", "tax"], ~late(), late(), ["yr"]))


def stored_states(t: Tables, features: list[str]) -> str:
    """States of the training years, and of the later ones added by a second call."""
    s, path = scored(t), scratch_path(t("lineitem").sparkSession)
    drift_states.start(s, path, features, "yr", [1995, 1996, 1997, 1998])
    drift_states.add_snapshots(s.where("yr <= 1998"), path, "yr")
    drift_states.add_snapshots(s, path, "yr")
    return path


@query(shown(HEAT.replace("*, case", "yr as snapshot, feature, psi, case"), snapshot="i", feature="s", psi="d", alert="s"))
def monitor_stored_drift(t: Tables) -> DataFrame:
    """The heat table from stored states."""
    path = stored_states(t, ["p1", "p2", "price", "tax"])
    d = drift_states.drift(t("lineitem").sparkSession, path, [1995, 1996, 1997, 1998])
    return rounded(d.withColumn("alert", monitoring.psi_alert(F.col("psi"), 0.10, 0.20, inclusive=True)))


@query(shown(" union all ".join(f"select case when yr <= 1998 then 'train' else 'oot' end as name, '{c}' as feature, count(*) as n, avg({c}) as mean, stddev_samp({c}) as std, min({c}) as least, max({c}) as most from ({SCORED}) group by all" for c in ("p1", "price")),
             name="s", feature="s", n="i", mean="d", std="d", least="d", most="d"))
def monitor_stored_moments(t: Tables) -> DataFrame:
    """Moments of groups of years, merged from the states of the years."""
    path = stored_states(t, ["p1", "price"])
    return rounded(drift_states.moments(t("lineitem").sparkSession, path, {"train": [1995, 1996, 1997, 1998], "oot": list(range(1999, 2010))}))


@query(f"select yr as snapshot, 'price' as feature, true as within from (select distinct yr from ({SCORED}) where yr > 1996)")
def monitor_rebased_drift(t: Tables) -> DataFrame:
    """PSI against another baseline by sketches is within 0.05 of that of a full run."""
    path, s = stored_states(t, ["price"]), scored(t)
    near = drift_states.rebased_drift(s.sparkSession, path, [1995, 1996])
    exact = monitoring.feature_drift(s, ["price"], F.col("yr") <= 1996, F.col("yr") > 1996, ["yr"]).select(F.col("yr").alias("snapshot"), "feature", F.col("psi").alias("exact"))
    return near.join(exact, ["snapshot", "feature"]).select("snapshot", "feature", (F.abs(F.col("psi") - F.col("exact")) < 0.05).alias("within"))


@query(shown(" union all ".join(f"select '{c}' as feature, case when yr <= 1998 then 'train' else 'oot' end as split, avg({c}) as mean, stddev_samp({c}) as std, count(*) as n from ({SCORED}) group by all" for c in ("p1", "price")),
             feature="s", split="s", mean="d", std="d", n="i"))
def monitor_feature_moments(t: Tables) -> DataFrame:
    return rounded(monitoring.feature_moments(scored(t).withColumn("split", F.when(late(), "oot").otherwise("train")), ["p1", "price"], "split"))


@query(shown(f"select a.yr as yr, a.ks as ks_champion, a.auc as auc_champion, b.ks as ks_baseline, b.auc as auc_baseline, a.ks - b.ks as delta_ks from ({ranking_sql('p2', 'yr')}) a join ({ranking_sql('p1', 'yr')}) b on a.yr = b.yr",
             yr="i", ks_champion="d", auc_champion="d", ks_baseline="d", auc_baseline="d", delta_ks="d"))
def monitor_backtest(t: Tables) -> DataFrame:
    return rounded(monitoring.backtest(scored(t), "label", "p2", "p1", ["yr"]))


@query(shown(f"""select yr, feature as model, psi, agreement, n from ({psi_sql(['p1', 'p2'], 'yr <= 1998', 'yr > 1998', 'yr')}) join (
    select yr as y2, m, avg(case when (v >= 0.5) = ((p1 + p2) / 2 >= 0.5) then 1.0 else 0.0 end) as agreement, count(*) as n from (
      select yr, p1, p2, 'p1' as m, p1 as v from ({SCORED}) union all select yr, p1, p2, 'p2', p2 from ({SCORED})) group by all) on y2 = yr and m = feature""", yr="i", model="s", psi="d", agreement="d", n="i"))
def monitor_models(t: Tables) -> DataFrame:
    s = scored(t).withColumn("both", (F.col("p1") + F.col("p2")) / 2)
    return rounded(monitoring.model_monitor(s, ["p1", "p2"], "both", "yr", TRAIN).select("yr", "model", "psi", "agreement", "n"))


@query(f"""select yr, coalesce(0.03 - ks > 0.05, false) as ks_alert, coalesce(4.0 - gini > 5, false) as gini_alert, coalesce(0.55 - auc > 0.03, false) as auc_alert,
    coalesce(0.03 - ks > 0.05, false) or coalesce(4.0 - gini > 5, false) or coalesce(0.55 - auc > 0.03, false) as degraded from ({ranking_sql('p2', 'yr')})""")
def monitor_performance_drift(t: Tables) -> DataFrame:
    d = monitoring.performance_drift(ranking_metrics(scored(t), "label", "p2", ["yr"]), {"ks": 0.03, "gini": 4.0, "auc": 0.55})
    return d.select("yr", "ks_alert", "gini_alert", "auc_alert", "degraded")


@query(f"select count(*) filter (where alert = 'RED') as n_red, count(*) filter (where alert = 'YELLOW') as n_yellow, case when count(*) filter (where alert = 'RED') > 0 then 'RETRAIN' when count(*) filter (where alert = 'YELLOW') > 0 then 'WARNING' else 'STABLE' end as status from ({HEAT})")
def monitor_overall_status(t: Tables) -> DataFrame:
    return monitoring.overall_status(monitoring.feature_drift(scored(t), ["p1", "p2", "price", "tax"], ~late(), late(), ["yr"]))


@query(f"""select *, case when scores_red > 0 or ks_low > 0 or features_red >= 3 then 2 when scores_yellow > 0 or features_yellow >= 5 then 1 else 0 end as retrain_code from
    (select count(*) filter (where psi >= 0.25) as scores_red, count(*) filter (where psi >= 0.1 and psi < 0.25) as scores_yellow from ({psi_sql(['p2'], 'yr <= 1998', 'yr > 1998', 'yr')})),
    (select count(*) filter (where alert = 'RED') as features_red, count(*) filter (where alert = 'YELLOW') as features_yellow from ({HEAT})),
    (select count(*) filter (where ks < 0.001) as ks_low from ({ranking_sql('p2', 'yr')}))""")
def monitor_retrain_status(t: Tables) -> DataFrame:
    s = scored(t)
    drift = monitoring.score_drift(s, "p2", "yr", TRAIN)
    heat = monitoring.feature_drift(s, ["p1", "p2", "price", "tax"], ~late(), late(), ["yr"])
    return monitoring.retrain_status(drift, heat, ranking_metrics(s, "label", "p2", ["yr"]), 0.001)


@query(f"select feature, max(psi) as max_psi, count(*) filter (where alert <> 'GREEN') as n_alerts from ({HEAT}) group by feature", name="monitor_drift_summary")
def monitor_drift_summary(t: Tables) -> DataFrame:
    h = monitoring.feature_drift(scored(t), ["p1", "p2", "price", "tax"], ~late(), late(), ["yr"])
    return h.groupBy("feature").agg(F.max("psi").alias("max_psi"), F.count_if(F.col("alert") != "GREEN").alias("n_alerts"))


@query(shown(f"select yr, {BAND.format(SCORE)} as band, count(*) as n, avg(label) as rate from ({SCORED}) group by all", yr="i", band="s", n="i", rate="d"))
def monitor_risk_evolution(t: Tables) -> DataFrame:
    s = scored(t).withColumn("band", scoring.risk_band(scoring.score_0_1000(F.col("p2"))))
    return rounded(s.groupBy("yr", "band").agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("rate")))
