"""Linear, ridge and lasso regression from sufficient statistics (M7-M9).

One pass sums, for every label, the Gram matrix X'X, the vector X'y, y'y and
the rows; all settings of all three trainers follow from these on the driver:

- linear:  min |y - Xw|^2                              (least norm, if several)
- ridge:   min |y - Xw|^2 / 2n + regParam / 2 |w|^2
- lasso:   min |y - Xw|^2 / 2n + regParam |w|_1        by coordinate descent

The lasso's settings are taken as a path, the largest penalty first, each
starting from the solution before. The driver holds d x d numbers a label.
With ``intercept`` the features and the label are centred.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

import numpy as np

from tablefit.operators.blocks import Block, Blocks, training_rows

LEAST_SQUARES = {"linear", "ridge", "lasso"}


@dataclass
class Moments:
    """Sums over the training rows of one label."""
    n: float
    gram: np.ndarray              # d x d
    xy: np.ndarray                # d
    yy: float
    x: np.ndarray                 # d
    y: float

    def centred(self) -> Moments:
        n = max(self.n, 1.0)
        return Moments(self.n, self.gram - np.outer(self.x, self.x) / n, self.xy - self.x * self.y / n,
                       self.yy - self.y * self.y / n, self.x, self.y)


def moments(blocks: Blocks, labels: Sequence[int] | None = None) -> dict[int, Moments]:
    """The sums for each label, in one pass."""
    wanted = list(range(len(blocks.labels))) if labels is None else list(labels)

    def per_task(parts: Iterable[Block]) -> dict[int, np.ndarray]:
        sums: dict[int, np.ndarray] = {}
        for block in parts:
            for i in wanted:
                x, y = training_rows(block, i)
                part = np.concatenate(([len(x), y @ y, y.sum()], x.sum(axis=0), x.T @ y, (x.T @ x).ravel()))
                sums[i] = sums[i] + part if i in sums else part
        return sums

    out = {}
    for i, v in blocks.summed(per_task).items():
        d = int(round((-2 + np.sqrt(4 + 4 * (len(v) - 3))) / 2))  # 3 + 2d + d^2 numbers
        out[i] = Moments(v[0], v[3 + 2 * d:].reshape(d, d), v[3 + d:3 + 2 * d], v[1], v[3:3 + d], v[2])
    return out


def lasso_path(m: Moments, penalties: Sequence[float], tol: float = 1e-12, sweeps: int = 10_000) -> dict[float, np.ndarray]:
    """Weights for each penalty."""
    w, out = np.zeros(len(m.xy)), {}
    for penalty in sorted(set(penalties), reverse=True):
        for _ in range(sweeps):
            largest = 0.0
            for j in range(len(w)):
                if m.gram[j, j] <= 0:
                    continue
                free = m.xy[j] - m.gram[j] @ w + m.gram[j, j] * w[j]
                new = np.sign(free) * max(abs(free) - m.n * penalty, 0.0) / m.gram[j, j]
                largest = max(largest, abs(new - w[j]) * np.sqrt(m.gram[j, j] / max(m.n, 1.0)))
                w[j] = new
            if largest <= tol * max(1.0, np.sqrt(m.yy / max(m.n, 1.0))):
                break
        out[penalty] = w.copy()
    return out


@dataclass
class LeastSquares:
    """A fitted model, with the interface of the other fitted models."""
    name: str
    params: dict
    weights: np.ndarray
    intercept: float = 0.0
    scored_label: str = "label"

    def coefficients(self) -> list[float]:
        return [float(v) for v in self.weights]


def fit_least_squares(m: Moments, settings: Sequence[tuple[str, Mapping]]) -> list[LeastSquares]:
    """Models for ``(trainer, params)`` pairs of one label."""
    if not m.n:
        raise ValueError("no labelled rows")
    paths: dict[bool, dict[float, np.ndarray]] = {}
    by_intercept = {False: m, True: m.centred()}
    for c in (False, True):
        penalties = [float(p.get("regParam") or 0.0) for name, p in settings
                     if name == "lasso" and bool(p.get("intercept", False)) == c]
        paths[c] = lasso_path(by_intercept[c], penalties) if penalties else {}
    out = []
    for name, params in settings:
        c = bool(params.get("intercept", False))
        s, penalty = by_intercept[c], float(params.get("regParam") or 0.0)
        if name == "lasso":
            w = paths[c][penalty]
        elif name == "ridge" and penalty > 0:
            w = np.linalg.solve(s.gram + s.n * penalty * np.eye(len(s.xy)), s.xy)
        elif name in ("linear", "ridge"):
            w = np.linalg.lstsq(s.gram, s.xy, rcond=None)[0]
        else:
            raise ValueError(f"no least squares trainer {name!r}; known: {sorted(LEAST_SQUARES)}")
        out.append(LeastSquares(name, dict(params), w, float((m.y - m.x @ w) / m.n) if c else 0.0))
    return out
