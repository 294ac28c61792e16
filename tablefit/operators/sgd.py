"""Opt-in gradient descent with the configured settings.

``pyspark.ml`` has no counterpart for ``step``, ``miniBatchFraction``,
``convergenceTol`` and ``initialWeights`` of the trainers the reference run
configures. ``tablefit.operators.gradient`` runs them on matrix blocks, all
models of a sweep in one pass a step; scoring happens JVM-side from the fitted
weights, so predictions are an ordinary column expression.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.operators.blocks import to_blocks
from tablefit.operators.gradient import LOSSES, Result, Spec, fit_descent
from tablefit.operators.trainers import trainer_params

SGD_TRAINERS = sorted(LOSSES)


@dataclass
class SgdFitted:
    name: str
    params: dict
    weights: np.ndarray
    intercept: float
    scored_label: str = "label"

    def prediction_column(self, x: Column) -> Column:
        w = F.array(*[F.lit(float(v)) for v in self.weights])
        margin = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0),
                             lambda acc, v: acc + v) + F.lit(float(self.intercept))
        if self.name == "logistic":      # threshold 0.5 on the probability
            return F.when(F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)) > 0.5, 1.0).otherwise(0.0)
        if self.name == "svm":           # threshold 0 on the margin
            return F.when(margin > 0.0, 1.0).otherwise(0.0)
        return margin

    def add_prediction(self, df: DataFrame, out_col: str, features_col: str = "features") -> DataFrame:
        return df.withColumn(out_col, self.prediction_column(
            vector_to_array(F.col(features_col), "float64")))

    def predict(self, df: DataFrame) -> DataFrame:
        return self.add_prediction(df, "prediction")

    def coefficients(self) -> list[float]:
        return [float(v) for v in self.weights]


def fitted_of(result: Result) -> SgdFitted:
    """A gradient fit with the interface of the other fitted models."""
    intercept = bool(result.spec.params.get("intercept", False))
    w = result.weights
    return SgdFitted(result.spec.name, dict(result.spec.params), w[:-1] if intercept else w,
                     float(w[-1]) if intercept else 0.0)


def fit_sgd(name: str, train: DataFrame, features_col: str = "features",
            label_col: str = "label", override: Mapping | None = None) -> SgdFitted:
    if name not in LOSSES:
        raise ValueError(f"no gradient trainer for {name!r}; known: {SGD_TRAINERS}")
    blocks = to_blocks(train, features_col, {label_col: F.col(label_col)})
    try:
        return fitted_of(fit_descent(blocks, [Spec(name, 0, trainer_params(name, override))])[0])
    finally:
        blocks.unpersist()
