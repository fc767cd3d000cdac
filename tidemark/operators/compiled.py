"""Fitted logistic pipelines as one column expression."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import ImputerModel, StandardScalerModel, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(terms: list[Column]) -> Column:
    """A sum as a balanced tree, so that many terms don't nest deeply."""
    if not terms:
        return F.lit(0.0)
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + ([terms[-1]] if len(terms) % 2 else [])
    return terms[0]


class Compiled:
    """A pipeline of imputer, assembler, scaler and logistic regression, in these or fewer stages.

    ``weights`` are the coefficients of the raw inputs, after filling, and
    ``intercept`` what belongs to them.
    """

    def __init__(self, model: PipelineModel):
        filled: dict[str, tuple[str, float]] = {}
        vectors: dict[str, list[tuple[str, float, float]]] = {}
        self.last: LogisticRegressionModel | None = None
        for stage in model.stages:
            if isinstance(stage, ImputerModel):
                found = stage.surrogateDF.first()
                filled |= {o: (i, float(found[i])) for i, o in zip(stage.getInputCols(), stage.getOutputCols())}
            elif isinstance(stage, VectorAssembler):
                vectors[stage.getOutputCol()] = [(c, 0.0, 1.0) for c in stage.getInputCols()]
            elif isinstance(stage, StandardScalerModel):
                with_mean, with_std = stage.getOrDefault("withMean"), stage.getOrDefault("withStd")
                means, stds = stage.mean.toArray(), stage.std.toArray()
                vectors[stage.getOutputCol()] = [
                    (c, float(means[k]) if with_mean else 0.0, (1 / float(stds[k]) if stds[k] else 0.0) if with_std else 1.0)
                    for k, (c, _, _) in enumerate(vectors[stage.getInputCol()])]
            elif isinstance(stage, LogisticRegressionModel) and stage.numClasses == 2 and stage.coefficientMatrix.numRows == 1:
                self.last = stage
            else:
                raise TypeError(f"{type(stage).__name__} has no expression")
        if self.last is None:
            raise TypeError("the pipeline doesn't end in a binary logistic regression")
        coefficients = self.last.coefficients.toArray()
        inputs = vectors[self.last.getFeaturesCol()]
        self.terms = [(float(w), *t, *filled.get(t[0], (t[0], None))) for w, t in zip(coefficients, inputs)]
        self.weights = {raw: w * scale for w, _, _, scale, raw, _ in self.terms}
        self.intercept = float(self.last.intercept) - sum(w * mean * scale for w, _, mean, scale, _, _ in self.terms)

    def value(self, raw: str, fill: float | None) -> Column:
        x = F.col(raw).cast("double")
        return x if fill is None else F.when(x.isNull() | F.isnan(x), F.lit(fill)).otherwise(x)

    def margin(self) -> Column:
        """The log-odds of label 1; null where an input without a filling is."""
        terms = [(self.value(raw, fill) - mean) * scale * w if mean else self.value(raw, fill) * scale * w for w, _, mean, scale, raw, fill in self.terms]
        return _sum(terms) + float(self.last.intercept)

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-self.margin()))


def logistic_probability(model: PipelineModel) -> Column | None:
    """The probability of label 1 as a column expression, or None for other models."""
    try:
        return Compiled(model).probability()
    except TypeError:
        return None


def card(model: PipelineModel, df: DataFrame, pdo: float = 50, base: float = 600) -> DataFrame:
    """The scorecard of a fitted logistic pipeline: feature, coefficient, points, base.

    ``coefficient`` belongs to a unit of the raw feature, ``points`` are what a
    unit adds to the score, scaled so that ``pdo`` points double the odds of
    label 0. ``base`` is the score of a row whose raw features are all zero, where
    a log-odds of 0 scores ``base``.
    """
    from tidemark.operators.scoring import scorecard_points

    c = Compiled(model)
    table = df.sparkSession.createDataFrame(list(c.weights.items()), "feature string, coefficient double")
    return scorecard_points(table, pdo, base).withColumn("base", F.lit(float(base)) - F.lit(c.intercept) * pdo / F.ln(F.lit(2.0)))


def card_score(card: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """(key, score): rows scored by the points of a card; its features are few and go into the expression."""
    rows = card.collect()
    base = rows[0]["base"] if rows else None
    return df.select(key, (_sum([F.col(r["feature"]).cast("double") * r["points"] for r in rows]) + F.lit(base)).alias("score"))
