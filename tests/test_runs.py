"""Merges, book runs, compiled checks and models, and samples: what they leave alone and what they read."""

import datetime as dt
from collections import Counter
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tidemark.operators import compiled, fitting, quality, sampling, selection
from tidemark.operators import relational as rel
from tidemark.operators.quality_plan import Suite
from tidemark.plans import book_run, q_data
from tidemark.plans.book_engine import build_book
from tidemark.plans.book_spec import Agg, BookSpec
from tidemark.plans.registry import tables
from tidemark.sources import files, io, merge

DIR = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def names(spark, path):
    """Files of a table by partition folder."""
    out = {}
    for f in spark.read.parquet(path).inputFiles():
        *_, folder, name = unquote(f).split("/")
        out.setdefault(folder, set()).add(name)
    return out


# ---- merging --------------------------------------------------------------------


def test_merge_leaves_other_partitions_alone(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    old = spark.createDataFrame([(k, k * 10, s) for k, s in ((1, "a"), (2, "a"), (3, "b/ x=1"), (4, None), (5, "c"), (6, "d"))], "k int, v int, s string")
    assert merge.merge_into(spark, path, old, ["k"], ["s"]) == sorted(names(spark, path))
    before = names(spark, path)
    # 1 changes in its place, 5 moves and leaves nothing behind, 4 changes where the partition is null, 9 is new
    changed = spark.createDataFrame([(1, 11, "a"), (5, 55, "b/ x=1"), (4, 44, None), (9, 99, "e")], "k int, v int, s string")
    touched = merge.merge_into(spark, path, changed, ["k"], ["s"])
    want = [(1, 11, "a"), (2, 20, "a"), (3, 30, "b/ x=1"), (4, 44, None), (5, 55, "b/ x=1"), (6, 60, "d"), (9, 99, "e")]
    assert rows(spark.read.parquet(path)) == sorted(want, key=str)
    after = names(spark, path)
    assert after["s=d"] == before["s=d"] and "s=c" not in after and "s=d" not in touched
    assert {f for f in before if f not in touched} == {"s=d"}


def test_merge_with_partition_keys_and_columns(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    old = spark.createDataFrame([(1, 202401, "x", 1), (None, 202401, "y", 2), (1, 202402, "x", 3)], "k int, m int, s string, v int")
    merge.merge_into(spark, path, old, ["k", "m"], ["m", "s"])
    # a null key matches a null key; the new column is null in old rows
    merge.merge_into(spark, path, spark.createDataFrame([(None, 202401, "y", 7, "new")], "k int, m int, s string, v int, w string"), ["k", "m", "s"], ["m", "s"])
    got = spark.read.option("mergeSchema", "true").parquet(path).select("k", "m", "s", "v", "w")
    assert rows(got) == sorted([(1, 202401, "x", 1, None), (None, 202401, "y", 7, "new"), (1, 202402, "x", 3, None)], key=str)


def test_a_swap_that_broke_off_is_undone(spark, tmp_path):
    path, staged = f"file://{tmp_path}/t", f"file://{tmp_path}/new"
    io.write_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "v int, s string"), path, ["s"])
    files.move(spark, f"{path}/s=a", f"{path}/{files.REPLACED}/run/s=a")
    assert [r[0] for r in rows(spark.read.parquet(path))] == [2]
    assert files.restore(spark, path) == ["s=a"] and files.restore(spark, path) == []
    assert [r[0] for r in rows(spark.read.parquet(path))] == [1, 2] and files.folders(spark, path) == ["s=a", "s=b"]
    io.write_overwrite(spark.createDataFrame([(3, "a")], "v int, s string"), staged, ["s"])
    files.swap(spark, staged, path, ["s=a", "s=b"])
    assert rows(spark.read.parquet(path)) == [(3, "a")]
    assert files.folders(spark, f"{path}/none") == [] and not files.exists(spark, f"{path}/{files.REPLACED}/run")


# ---- book runs --------------------------------------------------------------------

SPEC = BookSpec(client="k", date="at", aggregates=[Agg("n", "count"), Agg("total", "sum", "v")])
CUTOFFS = {202401: "2024-01-01", 202402: "2024-02-01", 202403: "2024-03-01"}


@pytest.fixture(scope="module")
def facts(spark):
    day = lambda m, d: dt.datetime(2023 if m > 6 else 2024, m, d)
    return spark.createDataFrame([("a", day(12, 5), 1.0), ("a", day(1, 5), 2.0), ("b", day(1, 9), 3.0), ("c", day(2, 1), 4.0), (None, day(2, 7), 5.0)], "k string, at timestamp, v double")


def test_one_failing_snapshot_leaves_the_others(spark, facts, tmp_path):
    target, built = f"file://{tmp_path}/book", []

    def failing(df, spec, cutoffs):
        built.append(sorted(cutoffs))
        if 202402 in cutoffs:
            raise RuntimeError("bad events")
        return build_book(df, spec, cutoffs)

    first = {r["snapshot"]: (r["status"], r["rows"]) for r in book_run.run_book(facts, SPEC, CUTOFFS, target, build=failing).collect()}
    assert first == {202401: ("SUCCESS", 1), 202402: ("FAILED", None), 202403: ("SUCCESS", 4)}
    assert built == [[202401, 202402, 202403], [202401], [202402], [202403]]
    before = names(spark, target)
    second = book_run.run_book(facts, SPEC, CUTOFFS, target).collect()
    assert [(r["snapshot"], r["status"], r["rows"]) for r in second] == [(202402, "SUCCESS", 2)]
    after = names(spark, target)
    assert {k: after[k] for k in before} == before and set(after) - set(before) == {"snapshot=202402"}
    assert rows(book_run.book_counts(spark, target)) == [(202401, 1, "SUCCESS"), (202402, 2, "SUCCESS"), (202403, 4, "SUCCESS")]
    # nothing is left to do; a changed book is built anew
    assert book_run.run_book(facts, SPEC, CUTOFFS, target).isEmpty()
    wider = BookSpec(client="k", date="at", aggregates=[*SPEC.aggregates, Agg("most", "max", "v")])
    assert book_run.run_book(facts, wider, CUTOFFS, target).count() == 3
    assert spark.read.parquet(target).columns == ["k", "cutoff", "n", "total", "most", "snapshot"]
    assert rows(spark.read.parquet(target).select("k", "snapshot", "n", "total", "most")) == rows(build_book(facts, wider, CUTOFFS).select("k", "snapshot", "n", "total", "most"))


def test_a_run_that_broke_off_before_its_record(spark, facts, tmp_path):
    target = f"file://{tmp_path}/book"
    book_run.run_book(facts, SPEC, {202401: "2024-01-01", 202312: "2023-12-01"}, target)
    assert rows(book_run.book_counts(spark, target)) == [(202312, 0, "EMPTY"), (202401, 1, "SUCCESS")]
    # as after a crash between the renames
    files.move(spark, f"{target}/snapshot=202401", f"{target}/{files.REPLACED}/run/snapshot=202401")
    book_run.run_book(facts, SPEC, {202402: "2024-02-01"}, target)
    assert rows(book_run.book_counts(spark, target)) == [(202312, 0, "EMPTY"), (202401, 1, "SUCCESS"), (202402, 2, "SUCCESS")]


def test_rollup_tells_null_segments_from_totals(spark):
    book = spark.createDataFrame([(1, "x", 2.0), (1, None, 3.0), (2, "x", 4.0)], "snapshot int, seg string, v double")
    got = rows(book_run.book_rollup(book, "seg", {"total": "sum(v)"}))
    assert got == sorted([("segment", 1, "x", 1, 2.0), ("segment", 1, None, 1, 3.0), ("segment", 2, "x", 1, 4.0), ("snapshot", 1, None, 2, 5.0), ("snapshot", 2, None, 1, 4.0), ("total", None, None, 3, 9.0)], key=str)


# ---- checks -----------------------------------------------------------------------


def test_compiled_checks_equal_single_ones(spark):
    t = tables(spark, DIR)
    got = [(r["layer"], r["entity"], r["check"], r["status"]) for r in q_data.suite(t).collect()]
    want = [(r["layer"], r["entity"], r["check"], r["status"]) for r in q_data.suite_by_check(t).collect()]
    assert sorted(got) == sorted(want) and len(got) == 18


def test_checks_of_a_table_read_it_once(spark):
    t = tables(spark, DIR)
    s = Suite()
    o = s.table(t("orders").withColumn("yr", F.year("o_orderdate")), "orders")
    o.has_rows("x").keys_not_null("x", ["o_orderkey"]).keys_unique("x", ["o_orderkey"]).keys_unique("x", ["o_custkey", "o_orderdate"])
    o.snapshots_are("x", "yr", [1995]).snapshots_balanced("x", "yr").volume_near("x", 5).null_rates("x", ["o_custkey", "o_totalprice", "o_orderstatus"])
    plan = s.result()._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan ==")[-1]
    assert initial.count("FileScan") == 1 and initial.count("Exchange hashpartitioning") == 1
    assert "o_orderpriority" not in initial


def test_checks_on_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (1, "x", 1), (None, None, 2), (2, "y", 9), (3, "z", None)], "k int, v string, s int")
    none = df.where("false")
    s = Suite()
    a = s.table(df, "a").keys_not_null("l", ["k"]).keys_unique("l", ["k"]).keys_unique("l", ["k", "v"]).null_rates("l", ["v"], 0.3).snapshots_are("l", "s", [1, 2, 3]).snapshots_balanced("l", "s", 0.6)
    b = s.table(none, "b").has_rows("l").keys_unique("l", ["k"]).snapshots_are("l", "s", [1]).snapshots_balanced("l", "s").null_rates("l", ["v"]).volume_near("l", 0).rows_at_most("l", a)
    a.rows_equal("l", b)
    got = [(r["entity"], r["check"], r["status"], r["detail"]) for r in s.result().collect()]
    assert got == [
        ("a", "key not null", "FAIL", "1"), ("a", "key unique", "FAIL", "1"), ("a", "key unique", "PASS", "0"), ("a", "null rate of v", "WARN", "0.4"),
        ("a", "snapshots as expected", "FAIL", "missing 3; unexpected 2, first 9"), ("a", "snapshots balanced", "WARN", "0.5"),
        ("b", "has rows", "FAIL", "0"), ("b", "key unique", "PASS", "0"), ("b", "snapshots as expected", "FAIL", "missing 1; unexpected 0"), ("b", "snapshots balanced", "WARN", None),
        ("b", "null rate of v", "WARN", None), ("b", "volume near expected", "PASS", "0"), ("b", "rows at most the source's", "PASS", "-5"), ("a", "rows equal the spine's", "FAIL", "5")]
    assert quality.summarise(s.result()).first()["overall"] == "FAIL"


# ---- models -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    x = F.col("id")
    return spark.range(600).select(
        x.alias("k"), F.when(x % 7 != 0, (x * 37 % 101).cast("double")).alias("a"), F.when(x % 5 == 0, float("nan")).otherwise(F.sqrt(x.cast("double"))).alias("b"), F.lit(3.0).alias("same"),
        ((x * 37 % 101 + x % 13) > 60).cast("int").alias("y")).withColumns({"_label": F.col("y").cast("double"), "_weight": F.lit(1.0)})


def test_expression_equals_the_pipeline(spark, labelled):
    model = fitting.lasso_pipeline(["a", "b", "same"], 0.001).fit(labelled)
    p = compiled.logistic_probability(model)
    from pyspark.ml.functions import vector_to_array

    both = model.transform(labelled).select(vector_to_array(F.col("probability"))[1].alias("p"), p.alias("q"))
    worst = both.agg(F.max(F.abs(F.col("p") - F.col("q"))).alias("d")).first()["d"]
    assert worst < 1e-12
    plan = fitting.predict(model, labelled, "p")._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "Python" not in plan
    # a model without an expression is told by None
    assert compiled.logistic_probability(fitting.boosted_pipeline(["a"], rounds=1, depth=1).fit(labelled)) is None


def test_a_card_scores_like_its_model(labelled):
    """Points of raw features add up to the log-odds on the card's scale."""
    model = fitting.lasso_pipeline(["a", "same"], 0.001).fit(labelled)
    whole = labelled.where("a is not null")
    card = compiled.card(model, labelled, pdo=20, base=500)
    scores = compiled.card_score(card, whole, "k").join(fitting.predict(model, whole, "p"), "k")
    off = scores.agg(F.max(F.abs(F.col("score") - (500 - 20 * F.log2(F.col("p") / (1 - F.col("p")))))).alias("d")).first()["d"]
    assert off < 1e-6


def test_fits_after_an_ingest_in_one_session(spark, labelled, tmp_path):
    labelled.select("k", "a").write.parquet(f"file://{tmp_path}/src")
    log = io.ingest_batch(spark, [io.Source("src", f"file://{tmp_path}/src")], io.TableStore(f"file://{tmp_path}", "bronze"), "raw")
    assert [(r["status"], r["rows"]) for r in log.collect()] == [("SUCCESS", 600)]
    model = fitting.lasso_pipeline(["a"]).fit(labelled)
    assert fitting.predict(model, labelled, "p").where("p between 0 and 1").count() == 600


# ---- samples --------------------------------------------------------------------------


@pytest.mark.parametrize("bits", [1, 4, 16])
def test_samples_are_the_first_by_hash(spark, bits):
    import hashlib

    data = [(k, "abc"[k % 3] if k % 10 else None) for k in range(500)] + [(None, "a")] * 5
    df = spark.createDataFrame(data, "k long, s string")
    h = lambda k: int(hashlib.md5(f"{k}:sample".encode()).hexdigest()[:8], 16)
    for percent, size in ((25, None), (0, None), (100, None), (None, 7), (None, 10_000)):
        want = set()
        for s in ("a", "b", "c", None):
            group = sorted((k for k, x in data if x == s and k is not None), key=lambda k: (h(k), k))
            want |= set(group[:size if size is not None else len(group) * percent // 100])
        got = [r["k"] for r in sampling.exact_sample(df, "k", ["s"], percent=percent, size=size, bits=bits).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert sampling.exact_sample(df.where("false"), "k", percent=10).count() == 0
    assert sampling.adaptive_sample(df, "k", most=1000).count() == 505 and sampling.adaptive_sample(df, "k", share=0.5, most=100).count() == 100
    with pytest.raises(ValueError):
        sampling.exact_sample(df, "k")


def test_stratified_sample_sizes(spark):
    df = spark.range(1000).withColumn("s", F.col("id") % 4)
    assert {r["count"] for r in selection.stratified_sample(df, ["s"], "id").groupBy("s").count().collect()} == {62}


def test_feature_store_renames_scores_and_drops_leaks(spark):
    spine = spark.createDataFrame([(1, 10), (2, 10)], "k int, s int")
    book = spark.createDataFrame([(1, 10, 5, 6)], "k int, s int, v int, TARGET_FPD int")
    scores = spark.createDataFrame([(2, 10, 0.5, 1)], "k int, s int, PROB_x double, vlr_fpd_sum int")
    got = rel.feature_store(spine, {"b": book, "none": None}, scores, ["k", "s"], "PROB_", "score_")
    assert got.columns == ["k", "s", "b_v", "score_x", "processed_at"]
    assert rows(got.drop("processed_at")) == sorted([(1, 10, 5, None), (2, 10, None, 0.5)], key=str) and got.where("processed_at is null").isEmpty()


# ---- stored states and sketches ---------------------------------------------------------


@pytest.fixture(scope="module")
def yearly(spark):
    x = F.col("id")
    return spark.range(4000).select(
        (x % 4 + 1).cast("int").alias("s"), (F.pmod(F.xxhash64(x), F.lit(1000)) / 10 + x % 4).alias("a"), F.when(x % 11 != 0, (x % 7).cast("int")).alias("b"), F.lit(1e9).cast("double").alias("same"))


def test_a_new_snapshot_reads_only_its_rows(spark, yearly, tmp_path):
    from tidemark.operators import binning, drift_states

    source, path = f"file://{tmp_path}/src", f"file://{tmp_path}/states"
    features = ["a", "b", "same"]
    io.write_overwrite(yearly.where("s <= 3"), source, ["s"])
    drift_states.start(spark.read.parquet(source), path, features, "s", [1, 2])
    assert drift_states.add_snapshots(spark.read.parquet(source), path, "s") == [1, 2, 3]
    before = rows(drift_states.stored(spark, path).drop("sketch", "counts"))
    # the old rows are gone from the source: what is stored doesn't ask for them again
    io.write_replace_partition(yearly.where("s = 4"), source, ["s"])
    io.write_replace_partition(yearly.where("s <= 3").limit(3), source, ["s"])
    assert drift_states.add_snapshots(spark.read.parquet(source), path, "s") == [4]
    assert drift_states.add_snapshots(spark.read.parquet(source), path, "s") == []
    after = rows(drift_states.stored(spark, path).drop("sketch", "counts"))
    assert [r for r in after if r[-1] != 4] == before
    # the plan reads the new snapshot's folder only
    plan = drift_states.states(spark.read.parquet(source).where("s = 4"), drift_states.stored_edges(spark, path), "s")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(s" in plan.replace("`", "")

    late = F.col("s") > 2
    edges = drift_states.stored_edges(spark, path)
    full = binning.psi_table(yearly, features, ~late, late, ["s"], edges=edges)
    assert rows(drift_states.drift(spark, path, [1, 2]).select("snapshot", "feature", F.round("psi", 5))) == rows(full.select(F.col("s").cast("long"), "feature", F.round("psi", 5)))
    assert drift_states.add_snapshots(spark.read.parquet(source), path, "s", again=[1]) == [1]


def test_moments_and_rebased_drift_of_states(spark, yearly, tmp_path):
    from tidemark.operators import binning, drift_states

    path = f"file://{tmp_path}/states"
    drift_states.start(yearly, path, ["a", "b", "same"], "s", [1])
    drift_states.add_snapshots(yearly, path, "s")
    got = {(r["name"], r["feature"]): r for r in drift_states.moments(spark, path, {"all": [1, 2, 3, 4], "late": [3, 4]}).collect()}
    for name, part in (("all", yearly), ("late", yearly.where("s > 2"))):
        for f in ("a", "b", "same"):
            want = part.agg(F.count(f).alias("n"), F.avg(f).alias("mean"), F.stddev_samp(f).alias("std"), F.min(f).alias("least"), F.max(f).alias("most")).first()
            r = got[name, f]
            assert r["n"] == want["n"] and (r["least"], r["most"]) == (want["least"], want["most"])
            assert abs(r["mean"] - want["mean"]) < 1e-9 * max(1, abs(want["mean"])) and abs(r["std"] - want["std"]) < 1e-9
    near = {(r["snapshot"], r["feature"]): r["psi"] for r in drift_states.rebased_drift(spark, path, [2, 3]).collect()}
    full = binning.psi_table(yearly, ["a", "b"], F.col("s").isin(2, 3), ~F.col("s").isin(2, 3), ["s"]).collect()
    # shares of ten bins may each be off by two rank errors
    assert all(abs(near[r["s"], r["feature"]] - r["psi"]) < 10 * 2 * drift_states.RANK_ERROR for r in full) and len(near) == 6


@pytest.mark.parametrize("seed", range(2))
def test_distinct_counts_over_horizons(spark, seed):
    import random

    from tidemark.operators import rolling_distinct

    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    data = [(rng.choice("ab"), start + dt.timedelta(days=rng.randrange(60), hours=rng.randrange(24)), rng.choice([None, *range(30)]), rng.randrange(5)) for _ in range(400)] + [("a", None, 1, 1), (None, start, 3, 3)]
    df = spark.createDataFrame(data, "k string, at timestamp, u int, v int")
    cutoffs, horizons, values = {1: "2024-01-20", 2: "2024-02-10", 3: "2024-02-11", 0: "2023-01-01"}, [3, 30, 400], {"us": "u", "vs": "v"}
    want = set()
    for k, c in cutoffs.items():
        for h in horizons:
            for who in ("a", "b", None):
                inside = [r for r in data if r[0] == who and r[1] and 0 <= (dt.date.fromisoformat(c) - r[1].date()).days <= h]
                counts = [len({r[i] for r in inside} - {None}) for i in (2, 3)]
                if any(counts):
                    want.add((who, k, h, *counts))
    assert set(rows(rolling_distinct.exact_counts(df, ["k"], "at", values, cutoffs, horizons))) == want
    both = rolling_distinct.compared(df, ["k"], "at", values, cutoffs, horizons)
    assert both.where(f"us_error > {4 * rolling_distinct.ERROR} or vs_error > {4 * rolling_distinct.ERROR}").isEmpty() and both.count() == len([w for w in want if w[0]])


# ---- importances and early stops ------------------------------------------------------------


def test_permutation_scores_every_version_in_one_pass(spark, labelled):
    model = fitting.lasso_pipeline(["a", "b"]).fit(labelled)
    df = labelled.withColumn("g", F.col("k") % 2)
    moved = fitting.permuted(df, ["a", "b"], "k", ["g"], bucket_rows=100)
    # each group keeps its values, and no row its own unless the bucket is that small
    for f in ("a", "same"):
        if f == "a":
            by = lambda c: rows(moved.groupBy("g", c).count())
            assert by("a") == by("_to_a")
    plan = moved._jdf.queryExecution().executedPlan().toString().split("Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1
    got = {(r["g"], r["feature"]): r for r in fitting.permutation_importance(model, df, "y", ["a", "b"], "k", ["g"]).collect()}
    # the same, a feature at a time
    from tidemark.operators.metrics import ranking_metrics

    whole = fitting.permuted(df, ["a", "b"], "k", ["g"])
    for f in ("a", "b"):
        one = whole.withColumn(f, F.col(f"_to_{f}"))
        for r in ranking_metrics(fitting.predict(model, one, "p"), "y", "p", ["g"]).collect():
            assert abs(got[r["g"], f]["auc_shuffled"] - r["auc"]) < 1e-12
    assert all(r["drop"] > 0.1 for (_, f), r in got.items() if f == "a")


def test_boosting_stops_on_the_validation_rows(labelled):
    noise = labelled.withColumns({"_label": (F.pmod(F.xxhash64("k"), F.lit(2))).cast("double"), "held": F.col("k") % 3 == 0})
    stopped = fitting.boosted_pipeline(["a"], rounds=30, depth=5, validation="held").fit(noise)
    assert stopped.stages[-1].getNumTrees < 30
    assert fitting.boosted_pipeline(["a"], rounds=3, depth=1).fit(labelled).stages[-1].getNumTrees == 3


def test_bands_within_groups(spark):
    data = [(g, v) for g in ("a", None) for v in (1.0, 1.0, 2.0, 3.0, None)] + [("b", 5.0)]
    df = spark.createDataFrame(data, "g string, v double")
    got = Counter(map(tuple, rel.relative_bands(df, ["g"], "v", 4).collect()))
    from pyspark.sql import Window

    share = F.cume_dist().over(Window.partitionBy("g").orderBy("v"))
    assert got == Counter(map(tuple, df.withColumn("band", F.least(F.floor(share * 4), F.lit(3))).collect()))
    assert Counter(k for _, _, k in got.elements())[3] == 5


def test_scratch_tables_go_on_demand(spark):
    path = io.scratch_path(spark)
    io.write_overwrite(spark.range(3).toDF("x"), path)
    other = io.scratch_path(spark)
    assert path != other and path.rsplit("/", 1)[0] == other.rsplit("/", 1)[0] and spark.read.parquet(path).count() == 3
    io.clear_scratch(spark)
    assert not files.exists(spark, path) and io.scratch_path(spark).rsplit("/", 1)[0] != path.rsplit("/", 1)[0]
