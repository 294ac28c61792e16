"""Logistic fits with an L2 penalty by Newton's method (M3, M4).

The objective, ``mean loss + regParam / 2 |w|^2``, is strictly convex and its
curvature is a small matrix (classes x features on a side), so a handful of
passes over matrix blocks reach its one minimum, however the features are
scaled: every task sums loss, gradient and curvature of its blocks, and one
small aggregate adds the tasks up. The number of passes does not depend on the
number of rows, as that of a line search at a loose tolerance does.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablefit.operators.blocks import Block, Blocks, training_rows

#: Weights of a model at most: their curvature is a matrix on each task.
MAX_WEIGHTS = 512
#: What a further step may gain at most, relative to the objective, once done.
GAIN = 1e-14
MAX_STEPS = 100


def fits_newton(params: Mapping) -> bool:
    """Whether the settings have the one minimum that is looked for here."""
    return (float(params.get("regParam") or 0.0) > 0 and params.get("regType", "l2") == "l2"
            and not params.get("intercept", False))


def _sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Rows, loss, gradient and curvature of some rows. ``w``: a row of weights
    a class; a single row is the two-class model."""
    n, d = x.shape
    score = x @ w.T
    if len(w) == 1:
        score = score[:, 0]
        loss = np.logaddexp(0.0, score).sum() - score @ y
        p = 1.0 / (1.0 + np.exp(-np.clip(score, -700.0, 700.0)))
        gradient = x.T @ (p - y)
        curvature = (x * (p * (1.0 - p))[:, None]).T @ x
        return np.concatenate(([n, loss], gradient, curvature.ravel()))
    top = score.max(axis=1, keepdims=True)
    p = np.exp(score - top)
    total = p.sum(axis=1, keepdims=True)
    own = y.astype(np.int64)
    loss = (np.log(total) + top).sum() - score[np.arange(n), own].sum()
    p /= total
    wide = (p[:, :, None] * x[:, None, :]).reshape(n, -1)
    curvature = -(wide.T @ wide)
    gradient = wide.sum(axis=0)
    for c in range(len(w)):
        at = slice(c * d, (c + 1) * d)
        gradient[at] -= x[own == c].sum(axis=0)
        curvature[at, at] += (x * p[:, c, None]).T @ x
    return np.concatenate(([n, loss], gradient, curvature.ravel()))


def newton_weights(blocks: Blocks, classes: int, penalty: float, width: int) -> np.ndarray:
    """Weights at the minimum, ``classes`` x ``width``, for the blocks' first
    label: a class index, or with one row of weights 0 or 1."""
    w, size = np.zeros((classes, width)), classes * width
    best, kept, step = np.inf, w, None
    for _ in range(MAX_STEPS):
        def per_task(parts: Iterable[Block], at: np.ndarray = w) -> dict[int, np.ndarray]:
            total = np.zeros(2 + size + size * size)
            for block in parts:
                x, y = training_rows(block, 0)
                if len(x):
                    total += _sums(x, y, at)
            return {0: total}

        sums = blocks.summed(per_task).get(0)
        if sums is None or not sums[0]:
            raise ValueError("no labelled rows")
        n = sums[0]
        value = sums[1] / n + penalty / 2 * float((w * w).sum())
        if step is None and not np.isfinite(value):
            break
        if step is not None and not value <= best + 1e-12 * abs(best):
            step = step / 2  # too far: half the way
            w = kept - step
            continue
        best, kept = value, w
        slope = sums[2:2 + size] / n + penalty * w.ravel()
        curve = sums[2 + size:].reshape(size, size) / n + penalty * np.eye(size)
        way = np.linalg.solve(curve, slope)
        step = way.reshape(w.shape)
        w = kept - step
        if slope @ way / 2 <= GAIN * max(abs(value), 1e-300):
            return w
    warnings.warn(f"the fit did not reach its minimum (features that are no finite numbers, or {MAX_STEPS} passes)")
    return kept


@dataclass
class LogisticFitted:
    """A fit with the interface of the other fitted models."""
    name: str
    params: dict
    matrix: np.ndarray                   # a row of weights a class; one for two classes
    labels: list[float] | None = None    # class values by index (multinomial)
    scored_label: str = "label"

    def prediction_column(self, x: Column) -> Column:
        """The prediction from ``x`` (the features as an array): a class value, the
        first best class winning; with two classes 0 or 1."""
        def score(weights: np.ndarray) -> Column:
            total = F.lit(0.0)
            for j, v in enumerate(weights):
                total = total + x[j] * F.lit(float(v))
            return total

        scores = [score(row) for row in self.matrix]
        if self.labels is None:
            return F.when(F.lit(1.0) / (F.lit(1.0) + F.exp(-scores[0])) > 0.5, 1.0).otherwise(0.0)
        if len(scores) == 1:
            return F.lit(float(self.labels[0]))
        best, out = F.greatest(*scores), F
        for value, own in zip(self.labels[:-1], scores):
            out = out.when(own == best, F.lit(float(value)))
        return out.otherwise(F.lit(float(self.labels[-1])))

    def add_prediction(self, df: DataFrame, out_col: str, features_col: str = "features") -> DataFrame:
        staged = df.withColumn("_x", vector_to_array(F.col(features_col), "float64"))
        return staged.withColumn(out_col, self.prediction_column(F.col("_x"))).drop("_x")

    def predict(self, df: DataFrame) -> DataFrame:
        return self.add_prediction(df, "prediction")

    def coefficients(self) -> list[float]:
        return [float(v) for v in self.matrix.ravel()] if self.labels is None else []
