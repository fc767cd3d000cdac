"""Hand-computed cases and invariants of the analytics operators."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.functions import clean, features
from tidemark.operators import binning, curves, decision, fitting, forest, metrics, monitoring, profiling, quality, relational, scoring, selection
from tidemark.plans.book_engine import build_book, build_book_by_snapshot
from tidemark.plans.books import billing_book, payment_book, recharge_book
from tidemark.plans.book_spec import Agg, BookSpec
from tidemark.sources import calendar, io


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_score_truncation_and_bands(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.5,), (0.9,), (1.0,)], "p double")
    assert [r[0] for r in df.select(scoring.score_0_1000(F.col("p"))).collect()] == [1000, 900, 500, 99, 0]
    s = spark.createDataFrame([(x,) for x in (0, 299, 300, 499, 500, 699, 700, 1000)], "s int")
    assert [r[0] for r in s.select(scoring.risk_band(F.col("s"))).collect()] == ["CRITICO"] * 2 + ["ALTO"] * 2 + ["MEDIO"] * 2 + ["BAIXO"] * 2


def test_score_round_is_half_even(spark):
    df = spark.createDataFrame([(0.9995,), (0.9985,), (0.9975,)], "p double")
    got = [r[0] for r in df.select(F.bround(F.lit(0.5)), scoring.score_round(F.col("p"))).collect()]
    assert got == [0.0, 0.0, 0.0]
    assert spark.range(1).select(F.bround(F.lit(1.5)), F.bround(F.lit(2.5))).first() == (2.0, 2.0)


def test_custom_dates(spark):
    df = spark.createDataFrame([("01MAY2024:00:00:00",), ("xx",), (None,)], "d string")
    assert [str(r[0]) if r[0] else None for r in clean.type_cast(df, {"d": "date"}).collect()] == ["2024-05-01", None, None]
    assert [str(r[0])[:10] if r[0] else None for r in clean.cast_by_metadata(df, {"d": "timestamp"}).collect()] == ["2024-05-01", None, None]


def test_dedup_latest(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 5, "z"), (2, 5, "y"), (None, 1, "n"), (None, 2, "m")], "k int, at int, v string")
    assert rows(clean.dedup_latest(df, ["k"], ["at"], ["v"])) == sorted([(1, 2, "b"), (2, 5, "y"), (None, 2, "m")], key=str)
    assert clean.dedup_latest(df.unionAll(df), None).count() == 6


def test_delay_buckets(spark):
    df = spark.createDataFrame([(x,) for x in (-1, 0, 1, 5, 6, 15, 16, 30, 31, None)], "d int")
    assert [r[0] for r in df.select(relational.delay_bucket(F.col("d"))).collect()] == [
        "EM_DIA", "EM_DIA", "01_05", "01_05", "06_15", "06_15", "16_30", "16_30", "30_PLUS", None]


def test_safe_divide(spark):
    df = spark.createDataFrame([(3, 0), (0, 3), (None, 3)], "a int, b int")
    assert [r[0] for r in df.select(clean.safe_divide(F.col("a"), F.col("b"), None)).collect()] == [None, 0.0, None]


def test_calendar(spark):
    c = calendar.generate_calendar(spark, "2010-01-01", "2035-12-31")
    assert c.count() == 9496 and len(c.columns) == 21
    assert c.where("day = date'2024-06-01'").select("is_weekend").first()[0] is True


def test_psi_of_itself_and_of_a_constant(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"), F.lit(5.0).alias("c"), (F.col("id") % 2).alias("side"))
    both = binning.psi_table(df.withColumn("x", F.col("x")), ["x", "c"], F.lit(True), F.lit(True))
    assert {r["feature"]: r["psi"] for r in both.collect()} == {"x": 0.0}


def test_ks_and_auc(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2), (1, 0.8), (1, 0.9), (None, 0.5)], "y int, s double").withColumn("flat", F.lit(1.0)).withColumn("neg", -F.col("s"))
    a, b, c = (metrics.ranking_metrics(df, "y", s).first() for s in ("s", "flat", "neg"))
    assert (a["ks"], a["auc"], a["n"]) == (1.0, 1.0, 4) and (b["ks"], b["auc"]) == (0.0, 0.5)
    assert a["auc"] + c["auc"] == 1.0
    assert metrics.ranking_metrics(df.where("y = 0"), "y", "s").first()["ks"] is None


def test_ranking_is_unchanged_by_monotone_maps(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 101).alias("s"), (F.hash("id") % 3 == 0).cast("int").alias("y")).withColumn("t", F.exp(F.col("s") / 50))
    a, b = (metrics.ranking_metrics(df, "y", s).first() for s in ("s", "t"))
    assert math.isclose(a["ks"], b["ks"]) and math.isclose(a["auc"], b["auc"])


def test_quantile_edges_and_bins(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (4,), (None,)], "x int")
    edges = binning.quantile_edges(df, ["x"], 4)["x"]
    assert edges == [1.0, 1.75, 2.5, 3.25, 4.0]
    assert [r[0] for r in df.select(binning.bin_of(F.col("x"), edges)).collect()] == [0, 1, 2, 3, None]


def test_information_value_of_degenerate_columns(spark):
    df = spark.createDataFrame([(1, 0.5, None), (1, 0.7, None)], "y int, x double, z double")
    assert {r["feature"]: r["iv"] for r in binning.information_value(df, ["x", "z"], "y").collect()} == {"x": 0.0, "z": 0.0}


def test_confusion_published_counts(spark):
    df = spark.createDataFrame([(2038733, 451353, 122277, 84258)], "tp long, fp long, tn long, fn long")
    r = metrics.confusion_rates(df).first()
    assert (round(r["precision"], 5), round(r["recall"], 6), round(r["f1"], 6)) == (0.81874, 0.960312, 0.883893)


def test_confusion_adds_up(spark):
    df = spark.range(100).select((F.col("id") % 2).cast("int").alias("y"), F.col("id").alias("s"))
    for r in metrics.confusion_at(df, "y", "s", [0, 50, 100]).collect():
        assert r["tp"] + r["fp"] + r["tn"] + r["fn"] == 100


def test_deciles_add_up(spark):
    df = spark.range(1003).select((F.hash("id") % 2 == 0).cast("int").alias("y"), F.rand(1).alias("s"))
    d = metrics.decile_table(df, "y", "s").collect()
    assert sum(r["n"] for r in d) == 1003 and max(r["cum_bad"] for r in d) == 1.0


def test_global_rank_equals_row_number(spark):
    df = spark.range(500).select(F.col("id"), (F.col("id") % 7).cast("double").alias("s"))
    got = curves.global_rank(df, "s", "id", parts=5).select("id", "rank", "n_rows").collect()
    want = {i: k + 1 for k, i in enumerate(sorted(range(500), key=lambda i: (-(i % 7), i)))}
    assert {r["id"]: r["rank"] for r in got} == want and {r["n_rows"] for r in got} == {500}


def test_tiles(spark):
    df = curves.global_rank(spark.range(23).select("id", F.col("id").cast("double").alias("s")), "s", "id")
    got = [r["n"] for r in df.groupBy(curves.tile(F.col("rank"), F.col("n_rows"), 10).alias("t")).agg(F.count(F.lit(1)).alias("n")).orderBy("t").collect()]
    assert got == [3, 3, 3] + [2] * 7


def test_null_label_is_not_good(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", None)], "g string, y int")
    r = relational.label_rate(df, "y", ["g"]).first()
    assert (r["total"], r["bad"], r["good"], r["unlabeled"], r["rate"]) == (3, 1, 1, 1, 0.5)


def test_upsert(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    b = spark.createDataFrame([(2, "B"), (3, "c"), (None, "N")], "k int, v string")
    assert rows(io.upsert(a, b, ["k"])) == sorted([(1, "a"), (2, "B"), (3, "c"), (None, "N")], key=str)


def test_join_dimensions_refuses_other_types(spark):
    f = spark.createDataFrame([(1,)], "k long")
    with pytest.raises(TypeError):
        relational.join_dimensions(f, [(spark.createDataFrame([("1", "x")], "d string, v string"), "k", "d", ["v"])])
    d = spark.createDataFrame([(1, "x"), (1, "x")], "d long, v string")
    assert rows(relational.join_dimensions(f, [(d, "k", "d", ["v"])])) == [(1, "x")]


def test_single_pass_book_equals_snapshot_loop(spark):
    facts = spark.range(400).select((F.col("id") % 13).alias("c"), F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, cast(id % 90 as int))").alias("at"),
                                    (F.col("id") * 37 % 101).cast("double").alias("v"), (F.col("id") % 5).alias("k"))
    spec = BookSpec("c", "at", [Agg("n", "count"), Agg("s", "sum", "v"), Agg("m", "avg", "v"), Agg("sd", "stddev", "v"), Agg("hi", "max", "v"), Agg("lo", "min", "v", "v > 0"),
                                Agg("d", "distinct", "k"), Agg("last", "latest", "k"), Agg("n0", "count", where="k = 0")], {}, {"r": "cast(n0 as double) / nullif(n, 0)"})
    cuts = {202402: "2024-02-01", 202403: "2024-03-01", 202404: "2024-04-01"}

    def shown(df):
        return sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in df.collect())

    assert shown(build_book(facts, spec, cuts)) == shown(build_book_by_snapshot(facts, spec, cuts))


def test_event_on_the_cutoff_is_not_seen(spark):
    facts = spark.sql("select 1 as c, timestamp'2024-02-01' as at, 2.0D as v")
    spec = BookSpec("c", "at", [Agg("n", "count"), Agg("sd", "stddev", "v")])
    assert [(r["snapshot"], r["n"], r["sd"]) for r in build_book(facts, spec, {1: "2024-02-01", 2: "2024-03-01"}).collect()] == [(2, 1, None)]


def test_published_books_have_their_features():
    for spec, least in ((recharge_book(), 90), (payment_book(), 94), (billing_book(), 114)):
        assert len(spec.features) >= least - 2 and len(set(spec.features)) == len(spec.features)


def test_retrain_codes(spark):
    p = lambda v: spark.createDataFrame([(v,)], "psi double")
    a = lambda *x: spark.createDataFrame([(v,) for v in x] or [("GREEN",)], "alert string")
    k = lambda v: spark.createDataFrame([(v,)], "ks double")
    code = lambda *x: monitoring.retrain_status(*x).first()["retrain_code"]
    assert code(p(0.01), a(), k(0.3)) == 0 and code(p(0.12), a(), k(0.3)) == 1 and code(p(0.25), a(), k(0.3)) == 2
    assert code(p(0.01), a("RED", "RED", "RED"), k(0.3)) == 2 and code(p(0.01), a(*["YELLOW"] * 5), k(0.3)) == 1 and code(p(0.01), a(), k(0.1)) == 2


def test_recommended_cutoff(spark):
    t = spark.createDataFrame([(300.0, 0.10, 0.9, 0.08), (500.0, 0.05, 0.5, 0.08), (700.0, 0.01, 0.1, 0.08)], "cutoff double, bad_rate double, approval_rate double, overall_bad_rate double")
    assert decision.recommend_cutoff(t).first()["cutoff"] == 500.0


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None)], "k int, v string")
    got = {(r["check"]): r["status"] for r in quality.run_suite([
        quality.keys_unique(df, ["k"], "l", "e"), quality.keys_not_null(df, ["v"], "l", "e"), quality.has_rows(df, "l", "e"), quality.types_conform(df, {"k": "bigint", "v": "varchar(3)"}, "l", "e")]).collect()}
    assert got == {"key unique": "FAIL", "key not null": "FAIL", "has rows": "PASS", "types conform": "FAIL"}
    assert quality.type_fits("int", "bigint") and not quality.type_fits("bigint", "int")


def test_impute_and_inf(spark):
    df = spark.createDataFrame([(1.0, True), (3.0, True), (None, True), (100.0, False), (float("inf"), False), (float("nan"), False)], "x double, fit boolean")
    out = clean.impute_median(clean.inf_to_null(df, ["x"]), ["x"], F.col("fit"))
    assert [r["x"] for r in out.collect()] == [1.0, 3.0, 2.0, 100.0, 2.0, 2.0]


def test_correlation_filter_prefers_iv_then_order(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("a"), (F.col("id") * 2.0).alias("b"), (F.col("id") % 5).cast("double").alias("c"))
    assert selection.correlation_filter(df, ["a", "b", "c"], {"b": 1.0}) == ["b", "c"]
    assert selection.correlation_filter(df, ["a", "b", "c"], {"b": 1.0}, keep=["a"]) == ["a", "c"]
    assert selection.correlation_filter(df, ["a", "b", "c"], {}) == ["a", "c"]


def test_buckets_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (2.1,)], "x double")
    assert [r[0] for r in df.select(features.bucket(F.col("x"), [0, 1, 2])).collect()] == [None, 0, 1, 1, None]


def test_ingest_isolates_failures(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x y;z=1\n1;2\n3;4\n")
    store = io.TableStore(f"file://{tmp_path}", "bronze")
    log = io.ingest_batch(spark, [io.Source("a", f"file://{tmp_path}/a.csv", "csv", {"header": "true", "sep": ";"}), io.Source("b", f"file://{tmp_path}/none.csv", "csv")], store, "staging", f"file://{tmp_path}/log")
    assert {(r["table"], r["status"], r["rows"]) for r in log.collect()} == {("a", "SUCCESS", 2), ("b", "FAILED", None)}
    assert spark.read.parquet(store.path("staging", "a")).columns[:2] == ["x_y", "z_1"]
    assert spark.read.parquet(f"file://{tmp_path}/log").count() == 2


def test_replacing_a_partition_keeps_the_others(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    io.write_overwrite(spark.createDataFrame([(1, 10), (2, 20)], "v int, s int"), path, ["s"])
    io.write_replace_partition(spark.createDataFrame([(3, 20)], "v int, s int"), path, ["s"])
    assert rows(spark.read.parquet(path).select("v", "s")) == [(1, 10), (3, 20)]
    assert quality.partitioned_by(spark, path, "s", "gold", "t").first()["status"] == "PASS"


def test_empty_tables(spark):
    e = spark.createDataFrame([], "y int, s double, k long")
    assert metrics.confusion_at(e, "y", "s", [1]).count() == 0
    assert relational.top_values(e, ["s"]).count() == 0


def test_enriched_metadata_counts_exactly(spark):
    """Every true key is one, and a column of 98 % distinct values isn't."""
    df = spark.range(5000).select(*(F.xxhash64("id", F.lit(k)).alias(f"key{k}") for k in range(16)), *(
        F.when(F.col("id") < 100, 0).otherwise(F.xxhash64("id", F.lit(99 + k))).alias(f"measure{k}") for k in range(4)))
    got = {r["column"]: (r["n_distinct"], r["role"], r["cardinality"]) for r in profiling.enriched_metadata(df, "t").collect()}
    assert got == {c: (5000, "key", "MUITO ALTA") if c[0] == "k" else (4901, "measure", "MUITO ALTA") for c in df.columns}


def test_enriched_metadata_query_equals_brute_force(spark):
    from tidemark.plans import catalog

    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/orders.parquet")
    data, kinds = [r.asDict() for r in table.collect()], profiling.column_kinds(table)
    got = {r["column"]: r for r in catalog.QUERIES["profile_enriched_metadata"](spark, folder).collect()}
    assert set(got) == set(kinds)
    for c, kind in kinds.items():
        n = len({r[c] for r in data} - {None})
        role = "constant" if n <= 1 else "date" if kind == "date" else "key" if n > 0.99 * len(data) else "measure" if kind == "numeric" and n > 10 else "category"
        grade = "CONSTANTE" if n <= 1 else "BAIXA" if n <= 10 else "MEDIA" if n <= 100 else "MUITO ALTA" if n > 0.95 * len(data) else "ALTA"
        assert (got[c]["role"], got[c]["cardinality"], got[c]["kind"]) == (role, grade, kind)


def test_histogram_holds_all_scores(spark):
    df = spark.createDataFrame([(x,) for x in (-5.0, -0.1, 0.0, 9.9, 10.0, 19.9, 20.0, 20.1, 99.0, None)], "s double")
    assert rows(scoring.score_histogram(df, "s", 0.0, 20.0, 2)) == [(0, 2), (1, 2), (2, 3), (3, 2)]


def test_book_deviation_of_large_values(spark):
    """Values of 1e9 that differ by 1, over several snapshots, against stddev."""
    rows = [(i % 3, f"2024-01-{1 + i % 28:02d} 00:00:00", 1e9 + i % 3 * (i % 2) + i % 5 if i % 3 else 1e-3 * (i % 7)) for i in range(3000)]
    facts = spark.createDataFrame(rows, "c int, d string, v double").withColumn("d", F.col("d").cast("timestamp"))
    spec = BookSpec(client="c", date="d", aggregates=[Agg("std", "stddev", "v")])
    cutoffs = {1: "2024-01-02", 2: "2024-01-09", 3: "2024-01-20", 4: "2024-02-01"}
    got = {(r["c"], r["snapshot"]): r["std"] for r in build_book(facts, spec, cutoffs).collect()}
    assert len(got) == 12
    for k, cut in cutoffs.items():
        for r in facts.where(F.col("d") < cut).groupBy("c").agg(F.stddev("v").alias("s")).collect():
            assert got[r["c"], k] == pytest.approx(r["s"], rel=1e-7)


def test_exact_quantiles_equal_percentile(spark):
    """Also with ties, nulls, null groups, a group without values and one row."""
    df = spark.range(4000).select(
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 3).alias("g"), F.when(F.col("id") % 7 > 0, F.pmod(F.xxhash64("id"), F.lit(1000)) / 7).alias("x"),
        F.when(F.col("id") % 2 == 0, 3.5).otherwise(-1.0).alias("y"), F.when(F.col("id") == 9, 1.0).alias("z"))
    levels = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    values = {c: F.col(c) for c in "xyz"}
    for by in ([], ["g"]):
        got = {(*(r[b] for b in by), r["feature"]): r["quantiles"] for r in curves.exact_quantiles(df, values, levels, by).collect()}
        for r in df.groupBy(*by).agg(*(F.percentile(c, F.array(*map(F.lit, levels))).alias(c) for c in "xyz")).collect():
            for c in "xyz":
                assert got.get((*(r[b] for b in by), c)) == r[c]
    assert curves.quantile_values(df.where("false"), values, [0.5]) == {"x": [None], "y": [None], "z": [None]}


def test_share_of_total_does_not_hang_on_the_order_of_rows(spark):
    values = [1e16, 1.0, -1e16, 0.25, float("nan")]
    for order in ([0, 1, 2, 3], [1, 0, 3, 2], [2, 3, 0, 1]):
        df = spark.createDataFrame([("a", values[i]) for i in order] + [("b", 0.75)], "g string, v double").coalesce(1)
        got = {r["g"]: (r["total"], r["share"], r["cum_share"]) for r in relational.share_of_total(df, ["g"], "v").collect()}
        assert got == {"a": (1.25, 0.625, 0.625), "b": (0.75, 0.375, 1.0)}
    odd = spark.createDataFrame([("a", float("inf")), ("b", None)], "g string, v double").groupBy("g").agg(relational.steady_sum(spark.createDataFrame([], "v double"), "v").alias("s"))
    assert {r["g"]: r["s"] for r in odd.collect()} == {"a": float("inf"), "b": None}


def test_frequency_encode_leaves_rows_where_they_are(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 1000, 1, 8).withColumn("c", F.when(F.col("id") % 10 > 0, F.when(F.col("id") % 4 == 0, "a").otherwise("b")))
        out = features.frequency_encode(df, "c", F.col("id") < 500)
        assert out.select(F.spark_partition_id()).distinct().count() == 8
        want = {"a": 100 / 500, "b": 350 / 500, None: 0.0}
        assert {r["c"]: r["c_freq"] for r in out.select("c", "c_freq").distinct().collect()} == want and out.count() == 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_forest_of_counted_rows_agrees_with_one_of_rows(spark):
    df = spark.range(0, 6000, 1, 4).select(
        F.col("id"), (F.hash("id") % 7).cast("double").alias("a"), F.rand(3).alias("b"), (F.hash(F.col("id") + 1) % 3).cast("double").alias("c"),
        F.when(F.col("id") % 50 > 0, F.rand(5)).alias("d"), F.lit(1.0).alias("_weight"))
    df = io.written(df.withColumn("_label", (F.col("a") + 4 * F.col("b") + F.rand(9) * 3 > 4).cast("double")))
    names = ["a", "b", "c", "d"]
    model = fitting.forest_pipeline(names, 60, 6, 50).fit(df)
    want = dict(zip(names, model.stages[-1].featureImportances.toArray()))
    got = {r["feature"]: r["share"] for r in forest.forest_importances(df, names, 60, 6, 50).collect()}
    assert abs(sum(got.values()) - 1) < 1e-9 and all(abs(got[f] - want[f]) < 0.05 for f in names), (got, want)


def test_forest_splits_as_worked_by_hand(spark):
    # one feature, no bootstrap: 40 rows of label 0 below, 60 of label 1 above; gini 0.48 to 0, and leaves are pure
    df = spark.range(100).select((F.col("id") >= 40).cast("double").alias("x"), (F.col("id") >= 40).cast("double").alias("_label"), F.lit(1.0).alias("_weight"))
    counted = forest.counted(df, ["x"], 32)
    assert sorted((r["_bins"], r["n0"], r["n1"]) for r in counted.collect()) == [([0], 40, 0), ([1], 0, 60)]
    sample = counted.select("_bins", F.lit(0).alias("tree"), "n0", "n1", (F.col("n0") * F.col("w0")).alias("w0"), (F.col("n1") * F.col("w1")).alias("w1"))
    found = forest.grow(sample, 1, 3, 10, 42).collect()
    assert [(r["tree"], r["feature"]) for r in found] == [(0, 0)] and abs(found[0]["gain"] - 48) < 1e-9
    assert forest.grow(sample, 1, 3, 50, 42).count() == 0


def test_only_rows_at_the_ranks_are_looked_up(spark, monkeypatch):
    df = spark.range(1003).select(F.col("id"), (F.col("id") * 7 % 5).cast("double").alias("s"), F.hash("id").cast("double").alias("t"), (F.hash("id") % 3 == 0).cast("int").alias("y"))
    ranks = [0, 1, 100, 502, 1002, 1003, 2000]
    want = {}
    for score in ("s", "t"):
        place = {r["id"]: r["rank"] for r in curves.global_rank(df, score, "id").collect()}
        want[score] = {i: [p <= r for r in ranks] for i, p in place.items()}
    overlap = sorted(map(tuple, decision.ranking_overlap(df, "y", "s", "t", "id", [0.1, 0.5]).select("share", "n_top", "overlap", "swap_in", "swap_out").collect()))
    a, b = ({i: w[2] for i, w in want[s].items()} for s in ("s", "t"))
    assert overlap[0] == (0.1, 100, sum(a[i] and b[i] for i in a), sum(a[i] and not b[i] for i in a), sum(b[i] and not a[i] for i in a))
    with monkeypatch.context() as m:
        m.setattr(curves, "global_rank", None)  # not all rows are ranked
        for score in ("s", "t"):
            rows_, up_to = curves.among_first(df, score, "id", ranks, 1003)
            assert {r[0]: list(r[1:]) for r in rows_.select("id", *up_to).collect()} == want[score]
    # rows equal in score and key straddle a rank: their number still holds
    twice = df.unionAll(df)
    rows_, up_to = curves.among_first(twice, "s", "id", [101], 2006)
    assert rows_.where(up_to[0]).count() == 101
    assert [r["n"] for r in metrics.gain_lift(df, "y", "s", "id").orderBy("slice").collect()] == [100] * 9 + [103]


def test_parts_are_counts_of_cuts(spark):
    for n in (1, 2, 3, 8, 9, 23):
        cuts = [float(i) for i in range(n)]
        got = spark.range(-2, 60).select((F.col("id") / 2).alias("v")).select("v", curves.part_of(F.col("v"), cuts).alias("p")).collect()
        assert all(r["p"] == sum(c < r["v"] for c in cuts) for r in got)
