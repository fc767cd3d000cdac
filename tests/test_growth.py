"""Steps whose time has to grow no faster than their input."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from tidemark.operators.binning import bin_of, left_closed_bin
from tidemark.operators.fitting import blend_weights
from tidemark.operators.metrics import ranking_metrics
from tidemark.plans import q_books
from tidemark.plans.book_engine import build_book, derived_layers
from tidemark.plans.book_run import run_book
from tidemark.plans.registry import tables


def test_wide_layers_of_a_book_are_no_single_methods(spark):
    for spec in (q_books.PAYMENT, q_books.BILLING, q_books.RECHARGE):
        layers = derived_layers(spec)
        assert sorted(n for x in layers for n in x) == sorted(spec.derived) and len(layers) < 8
        for k, layer in enumerate(layers):
            used = {w for n in layer for w in re.findall(r"\w+", spec.derived[n])}
            assert not used & {n for x in layers[k:] for n in x}
    book = build_book(q_books.payments(tables(spark, "/root/testdata/sf0.001")), q_books.PAYMENT, q_books.YEARS)
    plan = book._jdf.queryExecution().executedPlan().toString().split("\n")
    wide = [x for x in plan if "Project [" in x and "filter(" in x]
    assert len(wide) >= 2 and not any("*(" in x.partition("Project")[0] for x in wide)


def test_a_bad_cutoff_leaves_the_others_to_one_pass(spark, tmp_path):
    facts, passes = q_books.payments(tables(spark, "/root/testdata/sf0.001")), []

    def build(facts, spec, cutoffs):
        passes.append(sorted(cutoffs))
        return build_book(facts, spec, cutoffs)

    cutoffs = dict(list(q_books.YEARS.items())[:3]) | {200101: "2001-13-01"}
    run = run_book(facts, q_books.PAYMENT, cutoffs, f"file://{tmp_path}/book", build=build)
    assert {r["snapshot"]: r["status"] for r in run.collect()} == {k: "FAILED" if k == 200101 else "SUCCESS" for k in cutoffs}
    assert passes == [sorted(cutoffs), sorted(cutoffs)[:3], [200101]]


def test_few_edges_are_compared_in_compiled_code(spark):
    values = [None, float("nan"), -1.0, 0.0, -0.0, 1.0, 1.5, 2.0, 3.0, 9.0, 41.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for n in (2, 3, 11, 60):
        edges = [float(e) for e in range(n)]
        out = df.select("v", bin_of(F.col("v"), edges).alias("right"), left_closed_bin(F.col("v"), edges).alias("left"))
        assert n > 11 or "lambda" not in out._jdf.queryExecution().optimizedPlan().toString()
        for v, right, left in out.collect():
            none = v is None or v != v
            assert right == (None if none else sum(v > e for e in edges[1:-1]))
            assert left == (None if none else sum(v >= e for e in edges[1:-1]))


def test_blends_are_taken_of_counts(spark, tmp_path):
    rows = [(i % 2 if i % 7 else None, i % 3 / 4, None if i % 11 == 0 else i % 5 / 8) for i in range(600)]
    spark.createDataFrame([*rows, (1, float("nan"), 0.5)], "y int, a double, b double").write.parquet(f"file://{tmp_path}/rows")
    df = spark.read.parquet(f"file://{tmp_path}/rows")
    out = blend_weights(df, "y", ["a", "b"], 4)
    assert not any(f"{tmp_path}" in f for f in out.inputFiles())
    assert max(spark.read.parquet(f).count() for f in out.inputFiles()) <= 19
    found = {tuple(r["weights"]): (r["ks"], r["auc"], r["n"]) for r in out.collect()}
    assert sorted(found) == [(0.25, 0.75), (0.5, 0.5), (0.75, 0.25)]
    for (u, v), got in found.items():
        one = ranking_metrics(df.withColumn("p", F.round(F.col("a") * u + F.col("b") * v, 9)), "y", "p").first()
        assert got == (one["ks"], one["auc"], one["n"])
