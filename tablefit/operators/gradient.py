"""Many linear models in one pass a step.

All (label, setting) pairs of a sweep are fitted together: a step sends the
weights of every open model to the tasks, each task sums the losses and
gradients of its matrix blocks for all of them, and one small aggregate adds
the tasks up. So sixteen fits cost the scans of one.

Two ways to use that pass:

- ``fit_optimal`` minimises ``mean loss + regParam / 2 |w|^2`` (logistic or
  hinge loss) by cutting planes: every step adds the plane that supports the
  loss at the current weights, and the dual of the piecewise linear model, a
  small problem on the simplex, gives the next weights and a lower bound of
  the minimum. The gap between the best value and that bound proves how far
  the fit is from its optimum; it works for the hinge's kinks as well.
- ``fit_descent`` runs the gradient descent of the configured settings:
  ``step`` (divided by the root of the step's number), ``miniBatchFraction``,
  ``convergenceTol`` and ``initialWeights``, with the L2, L1 or no penalty.

Labels of the two-class losses are 1 where the label exceeds 0, else 0.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark import TaskContext

from tablefit.operators.blocks import Block, Blocks, training_rows

LOSSES = {"logistic": "logistic", "svm": "hinge", "linear": "squares", "ridge": "squares", "lasso": "squares"}
#: Relative duality gap at which a fit counts as optimal, and steps at most.
GAP = 1e-4
MAX_STEPS = 200


@dataclass
class Spec:
    name: str                     # trainer
    label: int                    # index among the blocks' labels
    params: Mapping = field(default_factory=dict)

    @property
    def loss(self) -> str:
        return LOSSES[self.name]


@dataclass
class Result:
    spec: Spec
    weights: np.ndarray           # the last one is the intercept, if there is one
    steps: int
    value: float | None = None    # objective at the weights
    bound: float | None = None    # proven lower bound of the minimum

    @property
    def gap(self) -> float | None:
        return None if self.value is None else self.value - self.bound


def _loss_and_slope(loss: str, margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Losses of rows x models and their derivatives by the margin."""
    if loss == "logistic":
        signed = np.where(y[:, None] > 0, margin, -margin)
        value = np.logaddexp(0.0, -signed)
        return value, -np.where(y[:, None] > 0, 1.0, -1.0) / (1.0 + np.exp(np.minimum(signed, 700.0)))
    if loss == "hinge":
        sign = np.where(y[:, None] > 0, 1.0, -1.0)
        short = 1.0 - sign * margin
        return np.maximum(short, 0.0), np.where(short > 0, -sign, 0.0)
    diff = margin - y[:, None]
    return diff * diff / 2.0, diff


def _with_one(x: np.ndarray, intercept: bool) -> np.ndarray:
    return np.hstack([x, np.ones((len(x), 1))]) if intercept else x


def losses_and_gradients(blocks: Blocks, specs: Sequence[Spec], weights: Sequence[np.ndarray],
                         step: int = 0, seed: int = 42) -> list[tuple[float, float, np.ndarray]]:
    """One pass: ``(rows, summed loss, summed gradient)`` for each model. A
    ``miniBatchFraction`` below 1 takes that share of the rows, drawn anew
    each step by task, block and step."""
    groups: dict[tuple, list[int]] = {}
    for i, s in enumerate(specs):
        share = float(s.params.get("miniBatchFraction", 1.0) or 1.0) if step else 1.0
        groups.setdefault((s.loss, s.label, bool(s.params.get("intercept", False)), share), []).append(i)
    stacked = {g: np.stack([weights[i] for i in members], axis=1) for g, members in groups.items()}

    def per_task(parts: Iterable[Block]) -> dict[int, np.ndarray]:
        sums: dict[int, np.ndarray] = {}
        context = TaskContext.get()
        task = context.partitionId() if context else 0
        for number, block in enumerate(parts):
            for (loss, label, intercept, share), members in groups.items():
                x, y = training_rows(block, label, loss != "squares")
                if share < 1.0:
                    drawn = np.random.default_rng((seed, step, task, number)).random(len(x)) < share
                    x, y = x[drawn], y[drawn]
                x = _with_one(x, intercept)
                value, slope = _loss_and_slope(loss, x @ stacked[loss, label, intercept, share], y)
                gradient = x.T @ slope
                for j, i in enumerate(members):
                    part = np.concatenate(([len(x), value[:, j].sum()], gradient[:, j]))
                    sums[i] = sums[i] + part if i in sums else part
        return sums

    total = blocks.summed(per_task)
    return [(v[0], v[1], v[2:]) if (v := total.get(i)) is not None else (0.0, 0.0, np.zeros_like(w))
            for i, w in enumerate(weights)]


def _width(blocks: Blocks) -> int:
    def per_task(parts: Iterable[Block]) -> dict[int, np.ndarray]:
        return {x.shape[1]: np.ones(1) for x, _, _ in parts}
    widths = blocks.summed(per_task)
    if len(widths) != 1:
        raise ValueError(f"rows need one number of features, got {sorted(widths) or 'no rows'}")
    return next(iter(widths))


def _start(spec: Spec, width: int) -> np.ndarray:
    size = width + bool(spec.params.get("intercept", False))
    given = spec.params.get("initialWeights")
    if given is None:
        return np.zeros(size)
    w = np.asarray(given, dtype=float)
    if w.size == width < size:
        w = np.append(w, 0.0)
    if w.size != size:
        raise ValueError(f"initialWeights has {w.size} values for {size} weights")
    return w


class _Planes:
    """The cutting planes of one model and the minimum of their model."""

    def __init__(self, penalty: float) -> None:
        self.penalty, self.slopes, self.offsets, self.share = penalty, [], [], np.zeros(0)

    def add(self, slope: np.ndarray, offset: float) -> None:
        self.slopes.append(slope), self.offsets.append(offset)
        self.share = np.append(self.share, 0.0 if len(self.share) else 1.0)

    def solve(self) -> tuple[np.ndarray, float]:
        """Weights and value of ``min_w max_i (slope_i w + offset_i) + penalty / 2 |w|^2``
        by pairwise steps on the dual simplex."""
        a, b, share = np.array(self.slopes), np.array(self.offsets), self.share
        gram = a @ a.T / self.penalty
        for _ in range(20_000):
            slack = b - gram @ share  # derivative of the dual
            up = int(np.argmax(slack))
            held = np.flatnonzero(share > 0)
            down = int(held[np.argmin(slack[held])])
            if slack[up] - slack[down] <= 1e-12 * max(1.0, abs(float(share @ b))):
                break
            curve = gram[up, up] + gram[down, down] - 2 * gram[up, down]
            move = share[down] if curve <= 0 else min(share[down], (slack[up] - slack[down]) / curve)
            share[up] += move
            share[down] -= move
            if share[down] < 1e-15:
                share[down] = 0.0
        share /= share.sum()
        self.share = share
        return -(share @ a) / self.penalty, float(share @ b - share @ gram @ share / 2)


def fit_optimal(blocks: Blocks, specs: Sequence[Spec], gap: float = GAP, max_steps: int = MAX_STEPS) -> list[Result]:
    """Optimal weights for every spec, one pass a step for all that are open.
    Needs ``regParam`` > 0 (the L2 penalty, which holds for all weights)."""
    for s in specs:
        if float(s.params.get("regParam") or 0.0) <= 0 or s.params.get("regType", "l2") != "l2":
            raise ValueError("cutting planes need the L2 penalty")
    width = _width(blocks)
    weights = [_start(s, width) for s in specs]
    planes = [_Planes(float(s.params["regParam"])) for s in specs]
    best = [Result(s, w, 0, np.inf, -np.inf) for s, w in zip(specs, weights)]
    open_ = list(range(len(specs)))
    for step in range(1, max_steps + 1):
        if not open_:
            break
        passes = losses_and_gradients(blocks, [specs[i] for i in open_], [weights[i] for i in open_])
        still = []
        for i, (n, loss, gradient) in zip(open_, passes):
            if not n:
                raise ValueError(f"no rows to fit {specs[i].name}")
            w, risk, slope = weights[i], loss / n, gradient / n
            value = risk + planes[i].penalty / 2 * float(w @ w)
            if value < best[i].value:
                best[i].value, best[i].weights = value, w
            planes[i].add(slope, risk - float(slope @ w))
            weights[i], bound = planes[i].solve()
            best[i].bound, best[i].steps = max(best[i].bound, bound), step
            if best[i].gap > gap * max(1e-12, abs(best[i].value)):
                still.append(i)
        open_ = still
    return best


def _penalised(spec: Spec, w: np.ndarray, gradient: np.ndarray, step: int) -> np.ndarray:
    size = float(spec.params.get("step", 1.0)) / np.sqrt(step)
    penalty = float(spec.params.get("regParam") or 0.0)
    kind = {"ridge": "l2", "lasso": "l1", "linear": None}.get(spec.name, spec.params.get("regType", "l2"))
    if kind == "l2":
        return w * (1.0 - size * penalty) - size * gradient
    moved = w - size * gradient
    return np.sign(moved) * np.maximum(np.abs(moved) - size * penalty, 0.0) if kind == "l1" else moved


def fit_descent(blocks: Blocks, specs: Sequence[Spec], seed: int = 42) -> list[Result]:
    """Gradient descent with the settings of each spec, one pass a step for all
    that are open: until ``iterations`` steps are done or the weights move by
    less than ``convergenceTol`` (relative to their length, if above 1)."""
    width = _width(blocks)
    weights = [_start(s, width) for s in specs]
    done = [0] * len(specs)
    open_ = [i for i, s in enumerate(specs) if int(s.params.get("iterations", 100)) > 0]
    step = 0
    while open_:
        step += 1
        passes = losses_and_gradients(blocks, [specs[i] for i in open_], [weights[i] for i in open_], step, seed)
        still = []
        for i, (n, _, gradient) in zip(open_, passes):
            spec, old, done[i] = specs[i], weights[i], step
            moved = False
            if n:
                weights[i] = _penalised(spec, old, gradient / n, step)
                change = float(np.linalg.norm(weights[i] - old))
                moved = change >= float(spec.params.get("convergenceTol", 0.001)) * max(float(np.linalg.norm(weights[i])), 1.0)
            if step < int(spec.params.get("iterations", 100)) and (moved or not n or step == 1):
                still.append(i)
        open_ = still
    return [Result(s, w, d) for s, w, d in zip(specs, weights, done)]
