"""Scores of many models in one pass, by partial sums.

Every model becomes a small numpy predictor. A task predicts its held-out rows
block by block and keeps, per model, the rows, the means and squared spreads of
prediction and label, and the summed absolute and squared errors; it returns
one row a model. Merging the tasks' rows by the means gives the same figures
as a pass over all pairs, without a row for each (row, model).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tablefit.operators.blocks import Block, Blocks

_PARTS = ["n", "p_mean", "p_spread", "y_mean", "y_spread", "abs_error", "sq_error"]


@dataclass
class Predictor:
    """``kind``: "linear" (weights, intercept), "sign" (1 where the margin
    exceeds ``cut``), "classes" (scores = intercepts + weights x, the first
    best class wins) or "steps" (piecewise linear through ``knots``)."""
    kind: str
    weights: np.ndarray
    intercept: np.ndarray | float = 0.0
    classes: np.ndarray | None = None
    feature: int = 0
    cut: float = 0.0


def predictor_of(fitted) -> Predictor:
    """The predictor of a fitted model of any trainer."""
    name = fitted.name
    if hasattr(fitted, "stats"):  # naive Bayes from statistics
        return Predictor("classes", fitted.theta, fitted.pi, np.asarray(fitted.stats.labels, dtype=float))
    if hasattr(fitted, "weights"):
        kind = "sign" if name in ("logistic", "svm") else "linear"
        return Predictor(kind, np.asarray(fitted.weights, dtype=float), float(fitted.intercept))
    model = fitted.estimator_model
    if name == "isotonic":
        knots = np.vstack([model.boundaries.toArray(), model.predictions.toArray()])
        return Predictor("steps", knots, feature=model.getFeatureIndex())
    if name in ("multinomial", "naive_bayes"):
        weights = model.coefficientMatrix.toArray() if name == "multinomial" else model.theta.toArray()
        intercept = model.interceptVector.toArray() if name == "multinomial" else model.pi.toArray()
        return Predictor("classes", weights, intercept, np.asarray(fitted.labels, dtype=float))
    kind = "sign" if name in ("logistic", "svm") else "linear"
    return Predictor(kind, model.coefficients.toArray(), float(model.intercept))


def predictions(models: Sequence[Predictor], x: np.ndarray) -> np.ndarray:
    """Rows x models."""
    out = np.empty((len(x), len(models)))
    flat = [i for i, m in enumerate(models) if m.kind in ("linear", "sign")]
    if flat:
        margin = x @ np.stack([models[i].weights for i in flat], axis=1) + np.array([float(models[i].intercept) for i in flat])
        for j, i in enumerate(flat):
            out[:, i] = margin[:, j] > models[i].cut if models[i].kind == "sign" else margin[:, j]
    by_classes: dict[tuple, list[int]] = {}
    for i, m in enumerate(models):
        if m.kind == "classes":
            by_classes.setdefault((tuple(m.classes), m.weights.shape), []).append(i)
        elif m.kind == "steps":
            out[:, i] = np.interp(x[:, m.feature], m.weights[0], m.weights[1]) if m.weights.size else np.nan
    for (classes, _), members in by_classes.items():
        theta = np.stack([models[i].weights for i in members])
        pi = np.stack([np.asarray(models[i].intercept) for i in members])
        scores = np.einsum("nd,mcd->nmc", x, theta) + pi[None, :, :]
        out[:, members] = np.asarray(classes)[scores.argmax(axis=2)]
    return out


def merged_parts(parts: np.ndarray) -> np.ndarray:
    """One row of ``_PARTS`` from several: spreads add up, with what the means differ."""
    n = parts[:, 0].sum()
    if not n:
        return np.zeros(len(_PARTS))
    out = np.empty(len(_PARTS))
    out[0] = n
    for mean, spread in ((1, 2), (3, 4)):
        out[mean] = parts[:, 0] @ parts[:, mean] / n
        out[spread] = parts[:, spread].sum() + parts[:, 0] @ (parts[:, mean] - out[mean]) ** 2
    out[5:] = parts[:, 5:].sum(axis=0)
    return out


def _parts(p: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Models x ``_PARTS`` of one block; pairs without a prediction or label take no part."""
    out = np.zeros((p.shape[1], len(_PARTS)))
    for j in range(p.shape[1]):
        both = ~(np.isnan(p[:, j]) | np.isnan(y[:, j]))
        a, b = p[both, j], y[both, j]
        if len(a):
            e = a - b
            out[j] = len(a), a.mean(), ((a - a.mean()) ** 2).sum(), b.mean(), ((b - b.mean()) ** 2).sum(), np.abs(e).sum(), e @ e
    return out


def score_models(blocks: Blocks, models: Sequence[Predictor], labels: Sequence[int], encoded: Sequence[bool],
                 held_out: bool = True) -> DataFrame:
    """``fit, n, var, mae, mse, r2, rmse`` per model, over the held-out rows (or
    the others). ``labels``: the label of each model; ``encoded``: score
    against 1 where the label exceeds 0, else 0."""
    models, labels, encoded = list(models), list(labels), list(encoded)

    def run(parts: Iterator[Block]) -> Iterator[tuple]:
        total = None
        for x, y, t in parts:
            rows = t if held_out else ~t
            if not rows.any():
                continue
            truth = y[rows][:, labels]
            positive = np.where(np.isnan(truth), np.nan, (truth > 0).astype(float))
            part = _parts(predictions(models, x[rows]), np.where(np.array(encoded), positive, truth))
            total = part if total is None else np.stack([merged_parts(np.stack(two)) for two in zip(total, part)])
        if total is not None:
            for i, part in enumerate(total.tolist()):
                yield i, *part

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        n, p, ps, y, ys, ae, se = merged_parts(rows[_PARTS].to_numpy())
        none = float("nan")
        mse = se / n if n else none
        return pd.DataFrame({
            "fit": [int(rows["fit"].iloc[0])], "n": [int(n)], "var": [ps / n + (p - y) ** 2 if n else none],
            "mae": [ae / n if n else none], "mse": [mse], "r2": [1 - se / ys if n and ys > 0 else none],
            "rmse": [np.sqrt(mse) if n else none]})

    parts = blocks.passed(run, "fit int, " + ", ".join(f"{c} double" for c in _PARTS))
    merged = parts.groupBy("fit").applyInPandas(
        merge, "fit int, n long, var double, mae double, mse double, r2 double, rmse double")
    figures = ["var", "mae", "mse", "r2", "rmse"]
    return merged.selectExpr("fit", "n", *[f"nullif({c}, double('NaN')) AS {c}" for c in figures])
