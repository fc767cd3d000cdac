"""Quality classifier: a sparse rule ensemble.

Shallow trees are grown on text statistics; every path from a root to a node is
a conjunctive rule, a 0/1 feature. A lasso logistic regression over the rules
keeps few of them, and these become one Spark column expression.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm._common import as_row, materialize, of_row
from tidemark.llm.quality_rules import FEATURES, held_statistics, labelled_statistics, with_statistics

def held_out(doc_id: Column) -> Column:
    """A third of the documents, told by the CRC-32 of the id's decimal text."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


#: A rule: bounds (feature, <= or >, threshold) that all have to hold.
Path = tuple[tuple[str, str, float], ...]


def rule_sql(path: Path) -> str:
    return " AND ".join(f"({FEATURES[f]}) {side} {t!r}D" for f, side, t in path)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted conjunctions over statistics, in log-odds of the positive label."""

    intercept: float
    rules: tuple[tuple[Path, float], ...]

    def score(self) -> Column:
        """Probability of the positive label, from the columns of ``with_statistics``."""
        total = " + ".join([repr(self.intercept) + "D", *(f"CASE WHEN {rule_sql(r)} THEN {w!r}D ELSE 0.0D END" for r, w in self.rules)])
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.expr(total)))


def paths(tree: DecisionTreeClassificationModel, features: list[str]) -> Iterator[Path]:
    """The conjunctions at all nodes of a tree but its root.

    Tests on one feature along a path are drawn together to its tightest bounds.
    """
    # nodes are read one by one; a tree of depth d has 2**(d + 1) of them at most
    waiting = [(tree._call_java("rootNode"), {})]
    while waiting:
        node, bounds = waiting.pop()
        if bounds:
            yield tuple((features[f], side, t) for (f, side), t in sorted(bounds.items()))
        if node.subtreeDepth() == 0:
            continue
        split = node.split()
        f, t = split.featureIndex(), split.threshold()
        for side, best, child in ((">", max, node.rightChild()), ("<=", min, node.leftChild())):
            waiting.append((child, bounds | {(f, side): best(bounds.get((f, side), t), t)}))


def rule_flags(rows: DataFrame, rules: list[Path], features: list[str]) -> DataFrame:
    """``label`` and, as an array ``rules`` of 0 and 1, which rules hold for the vector ``x`` of the features.

    The bounds go to the tasks as two matrices: as expressions hundreds of rules are a plan
    and a generated method that weigh on the driver.
    """
    above, most = np.full((len(features), len(rules)), -np.inf), np.full((len(features), len(rules)), np.inf)
    for j, rule in enumerate(rules):
        for f, side, t in rule:
            (above if side == ">" else most)[features.index(f), j] = t

    def flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, len(features))
            held = np.ones((len(x), len(rules)), bool)
            for i in range(len(features)):
                held &= (x[:, i, None] > above[i]) & (x[:, i, None] <= most[i])
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(rules))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.ListArray.from_arrays(ends, pa.array(held.ravel().astype(float)))], ["label", "rules"])

    return rows.select("label", vector_to_array("x").alias("x")).mapInArrow(flags, "label double, rules array<double>")


def _sums_at(intercept: float, weights: np.ndarray | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's share of the loss at these weights and of the normal equations of the least-squares step there.

    One row of bytes for a task: the loss, then for a leading 1 and the rules the sums
    of squares and products, and those with the target of the step.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | float = 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            y = batch.column("label").to_numpy(zero_copy_only=False)
            flags = batch.column("rules").flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1)
            x = np.hstack([np.ones((len(y), 1)), flags])
            margin = np.full(len(y), intercept) if weights is None else intercept + x[:, 1:] @ weights
            p = 1.0 / (1.0 + np.exp(-margin))
            w = np.maximum(p * (1.0 - p), 1e-5)
            loss = np.maximum(margin, 0.0) - y * margin + np.log1p(np.exp(-np.abs(margin)))
            total = total + np.concatenate([[len(y), loss.sum()], ((x.T * w) @ x).ravel(), x.T @ (w * margin + y - p)])
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    return sums


def _least_squares(squares: np.ndarray, targets: np.ndarray, penalty: float, start: np.ndarray, sweeps: int = 1000) -> tuple[float, np.ndarray]:
    """Intercept and weights of a least-squares lasso from its normal equations, by coordinate descent.

    The first row and column belong to the intercept, which has no penalty.
    """
    mean = squares[0, 1:] / squares[0, 0]
    around = squares[1:, 1:] - np.outer(mean, squares[0, 1:])
    own, weights = np.diag(around).tolist(), start.copy()
    rest = targets[1:] - mean * targets[0] - around @ weights
    for _ in range(sweeps):
        moved = 0.0
        for j, square in enumerate(own):
            if square <= 1e-9 * squares[0, 0]:  # a rule that holds everywhere or nowhere
                continue
            old, pull = float(weights[j]), float(rest[j]) + square * float(weights[j])
            now = np.sign(pull) * max(abs(pull) - penalty, 0.0) / square
            if now != old:
                weights[j] = now
                rest -= around[j] * (now - old)
                moved = max(moved, square * (now - old) ** 2)
        if moved <= 1e-12 * squares[0, 0]:
            break
    return float(targets[0] / squares[0, 0] - mean @ weights), weights


def lasso(rows: DataFrame, penalty: float, most: int = 40, tolerance: float = 1e-5) -> tuple[float, np.ndarray]:
    """Intercept and weights that minimise mean logistic loss + penalty * sum of absolute weights.

    ``rows`` have ``label`` (0 or 1, both occur) and a vector ``rules``. Each step is one
    job: every task sums up the loss and the weighted normal equations around the weights so
    far, of which the driver gets (rules + 1)**2 numbers a task. All steps have the same
    plan, and nothing is compiled for one. A step that makes things worse is halved.
    """
    flags = rows.select(F.col("label").cast("double").alias("label"), vector_to_array("rules", "float32").alias("rules"))
    now: tuple[float, np.ndarray | None] = (0.0, None)
    best, least = now, np.inf
    for _ in range(most):
        total = np.sum([np.frombuffer(r["sums"]) for r in flags.mapInArrow(_sums_at(*now), "sums binary").collect()], axis=0)
        k = int(np.sqrt(len(total)))  # k * k + k + 2 numbers
        n, loss, squares, targets = total[0], total[1], total[2:2 + k * k].reshape(k, k), total[2 + k * k:]
        if now[1] is None:
            now = (now[0], np.zeros(k - 1))
        value = loss / n + penalty * float(np.abs(now[1]).sum())
        if value > least:
            now = (now[0] + best[0]) / 2, (now[1] + best[1]) / 2
            continue
        gained, best, least = least - value, now, value
        if gained <= tolerance * least:
            break
        now = _least_squares(squares, targets, penalty * n, now[1])
    return best


def fit(table: DataFrame, n_trees: int = 20, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> RuleEnsemble:
    """Fit on labelled statistics with a column ``good`` of 0 and 1.

    There are as many rules as different paths in the trees, n_trees * 2**(depth + 1)
    at most; the lasso weights choose among them. With rows of one label only
    every text gets a log-odds of 4 for that label, without rows 0.
    """
    features = list(FEATURES)
    shares = {r["good"]: r["n"] for r in table.groupBy("good").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(shares) < 2:
        return RuleEnsemble({0: -4.0, 1: 4.0}.get(next(iter(shares), None), 0.0), ())
    rows = table.select(F.col("good").cast("double").alias("label"), *(F.expr(FEATURES[f]).cast("double").alias(f"f_{f}") for f in features))
    rows = VectorAssembler(inputCols=[f"f_{f}" for f in features], outputCol="x").transform(rows)
    # both labels weigh the same while the trees grow, or the rare one gets few rules
    weight = {g: sum(shares.values()) / (2.0 * n) for g, n in shares.items()}
    grown = rows.withColumn("weight", F.when(F.col("label") == 1, weight[1]).otherwise(weight[0]))
    forest = RandomForestClassifier(
        featuresCol="x", labelCol="label", weightCol="weight", numTrees=n_trees, maxDepth=depth, maxBins=64,
        featureSubsetStrategy="sqrt", minInstancesPerNode=5, seed=seed).fit(grown.select("x", "label", "weight"))
    rules = list(dict.fromkeys(r for t in forest.trees for r in paths(t, features)))
    if not rules:
        return RuleEnsemble(0.0, ())
    hits = materialize(rule_flags(rows.select("label", "x"), rules, features).select("label", array_to_vector("rules").alias("rules")).coalesce(4))
    intercept, weights = lasso(hits, penalty)
    return RuleEnsemble(intercept, tuple((r, float(w)) for r, w in zip(rules, weights) if w))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> RuleEnsemble:
    """Fit on at most ``max_rows`` labelled documents outside the held-out third."""
    return fit(labelled_statistics(docs, labels.where(~held_out(F.col("doc_id"))), max_rows))


def scored(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text.

    A null text counts as empty and is scored like one, a very long one is measured
    whole; repeated rows are scored each, equal texts alike; a score of exactly 0.5
    predicts 1; a null doc_id is not held out; an empty table gives no rows; other
    columns are ignored.
    """
    rows = with_statistics(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).withColumn("score", model.score())
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def keep_good(docs: DataFrame, model: RuleEnsemble) -> DataFrame:
    """The documents that are predicted to be of good quality, columns unchanged."""
    rows = docs.select(as_row(docs).alias("row"), "text")
    return held_statistics(rows).where(model.score() >= 0.5).select(*of_row("row", docs.columns))
