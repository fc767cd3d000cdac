"""Work that has to grow with what is new, not with what is held already."""

from __future__ import annotations

import numpy as np
from pyspark.ml.linalg import Vectors

from tidemark.llm import quality_classifier, quality_rules
from tidemark.llm.quality_classifier import RuleEnsemble
from tidemark.llm.token_counts import SegmentTree
from tidemark.llm.tokens import WordEncoder, default_tokenizer


def test_a_new_word_copies_no_words_met_before():
    encoder = WordEncoder(default_tokenizer())
    encoder.encode("the words of a first text " * 3)
    before = encoder.ids, encoder.ends
    found = encoder.pieces_of("quixotically zebra'd")
    assert np.shares_memory(before[0], encoder.ids) and np.shares_memory(before[1], encoder.ends)
    assert [n for _, n in found] == [len(encoder.encode(w)) for w in ("quixotically", "zebra'd")]


def test_edits_next_to_emptied_leaves():
    encoder = WordEncoder(default_tokenizer())
    text = " ".join(f"word{i % 7} and" for i in range(200))
    (chars, tokens), = encoder.leaves([text])
    tree, rng = SegmentTree(text, chars, tokens, encoder.pieces_of, crowded=10**9), np.random.default_rng(3)
    for k in range(60):
        start, length = int(rng.integers(0, len(text))), int(rng.integers(0, 40))
        new = "" if k % 3 else "new ones"
        tree.edit(start, length, new)
        text = text[:start] + new + text[start + length:]
        assert tree.flat()[0] == text and tree.n_chars == len(text)
        assert tree.n_tokens == len(encoder.encode(text))
        assert sum(tree.chars[tree.width:]) == tree.chars[1] and sum(tree.tokens[tree.width:]) == tree.tokens[1]


def test_a_filter_by_score_names_the_statistics_once(spark):
    docs = spark.createDataFrame([(i, "Some words, and some words. " * (i % 4 * 9)) for i in range(40)] + [(40, None)], "doc_id long, text string")
    model = RuleEnsemble(-0.5, (((("mean_word", ">", 2.0), ("repeat_share", "<=", 0.9)), 1.5), ((("stop_share", ">", 0.1), ("mean_word", "<=", 9.0)), -0.25)))
    kept, plain = quality_classifier.keep_good(docs, model), quality_rules.with_statistics(docs).where(model.score() >= 0.5)
    assert kept._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 2  # words and lines
    assert kept.orderBy("doc_id").collect() == plain.select("doc_id", "text").orderBy("doc_id").collect()


def test_lasso_needs_few_jobs_and_reaches_the_optimum(spark):
    rng = np.random.default_rng(5)
    x = (rng.random((600, 12)) < 0.4).astype(float)
    x[:, 11] = x[:, 0]
    y = (rng.random(600) < 1 / (1 + np.exp(-(2 * x[:, 0] - 1.5 * x[:, 1] - 0.5)))).astype(float)
    rows = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "rules"]).coalesce(2)
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
    before = jobs()
    intercept, weights = quality_classifier.lasso(rows, 0.01)
    assert jobs() - before <= 60
    slope = x.T @ (1 / (1 + np.exp(-(intercept + x @ weights))) - y) / 600
    assert (abs(slope) < 0.0105).all() and (abs(slope + 0.01 * np.sign(weights))[weights != 0] < 5e-4).all()


def test_a_step_of_the_lasso_is_one_job_and_rules_are_no_expressions(spark):
    rng = np.random.default_rng(6)
    x = rng.random((400, 2)).round(2)
    y = ((x[:, 0] > 0.5) & (x[:, 1] <= 0.7)).astype(float)
    rows = spark.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x, y)], ["label", "x"]).coalesce(3)
    cuts = [i / 50 for i in range(1, 50)]
    rules = [(("a", "<=", t),) for t in cuts] + [(("a", ">", t), ("b", "<=", 0.7)) for t in cuts] + [(("b", ">", 0.1), ("b", "<=", t)) for t in cuts]
    found = quality_classifier.rule_flags(rows, rules, ["a", "b"])
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 2000
    plain = [[float(eval(" and ".join(f"{f} {side} {t!r}" for f, side, t in r), {"a": a, "b": b})) for r in rules] for a, b in x.tolist()]
    got = found.collect()
    assert [r["label"] for r in got] == y.tolist() and [r["rules"] for r in got] == plain
    hits = spark.createDataFrame([(r["label"], Vectors.dense(r["rules"])) for r in got], ["label", "rules"]).coalesce(3)
    jobs = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
    before = jobs()
    intercept, weights = quality_classifier.lasso(hits, 0.01)
    assert jobs() - before <= 20
    flags = np.array(plain)
    slope = flags.T @ (1 / (1 + np.exp(-(intercept + flags @ weights))) - y) / 400
    assert (abs(slope) < 0.0105).all()
