"""Fits and scores from matrix blocks, next to plain numpy versions."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablefit.operators import scoring
from tablefit.operators import trainers as tr
from tablefit.operators.blocks import counts, to_blocks, training_rows, unpacked
from tablefit.operators.gradient import Spec, _Planes, fit_descent, fit_optimal, losses_and_gradients
from tablefit.operators.least_squares import Moments, fit_least_squares, lasso_path, moments
from tablefit.operators.metrics import regression_metrics
from tablefit.plans import model_run as mr


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    x = np.abs(rng.normal(size=(3000, 4)))
    x /= x.sum(axis=1, keepdims=True)
    y1 = np.where(x @ [3, -2, 1, -1] + rng.normal(size=3000) * 0.5 > 0.2, 1.0, -1.0)
    y2 = np.round(x @ [1, 4, 2, 0] + rng.normal(size=3000), 3)
    y2[::7] = np.nan
    return x, np.stack([y1, y2], axis=1), rng.random(3000) < 0.3


@pytest.fixture(scope="module")
def frame(spark, data):
    x, y, t = data
    rows = [(Vectors.dense(a), float(b[0]), None if np.isnan(b[1]) else float(b[1]), bool(c)) for a, b, c in zip(x, y, t)]
    return spark.createDataFrame(rows, ["features", "y1", "y2", "is_test"]).repartition(5).cache()


@pytest.fixture(scope="module")
def blocks(frame):
    return to_blocks(frame, "features", {"y1": F.col("y1"), "y2": F.col("y2")}, F.col("is_test"))


def train_of(data, label, positive=False):
    x, y, t = data
    keep = ~t & ~np.isnan(y[:, label])
    return x[keep], (y[keep, label] > 0).astype(float) if positive else y[keep, label]


def test_blocks_hold_all_rows(blocks, data):
    x, y, t = data
    assert counts(blocks) == (3000, int(t.sum()))
    got = []
    for r in blocks.frame.toArrow().to_batches():
        got += [(tuple(a), c) for bx, by, bt in unpacked([r]) for a, c in zip(bx, bt)]
    assert sorted(got) == sorted((tuple(a), bool(c)) for a, c in zip(x, t))


def test_losses_and_gradients_equal_numpy(blocks, data):
    rng = np.random.default_rng(0)
    specs = [Spec("logistic", 0), Spec("svm", 0), Spec("linear", 1), Spec("logistic", 1, {"intercept": True})]
    weights = [rng.normal(size=4 + bool(s.params.get("intercept"))) for s in specs]
    for s, w, (n, loss, g) in zip(specs, weights, losses_and_gradients(blocks, specs, weights)):
        x, y = train_of(data, s.label, s.name != "linear")
        if s.params.get("intercept"):
            x = np.hstack([x, np.ones((len(x), 1))])
        m, sign = x @ w, 2 * y - 1
        if s.name == "logistic":
            want = np.log1p(np.exp(-sign * m)).sum(), -(sign / (1 + np.exp(sign * m))) @ x
        elif s.name == "svm":
            want = np.maximum(0, 1 - sign * m).sum(), -(sign * (1 - sign * m > 0)) @ x
        else:
            want = ((m - y) ** 2).sum() / 2, (m - y) @ x
        assert n == len(x) and np.isclose(loss, want[0]) and np.allclose(g, want[1])


def test_cutting_planes_prove_the_optimum(blocks, frame, data):
    specs = [Spec(t, 0, {"regParam": r}) for t in ("logistic", "svm") for r in (0.01, 0.005)]
    found = fit_optimal(blocks, specs, gap=1e-6)
    x, y = train_of(data, 0, True)
    sign = 2 * y - 1
    rng = np.random.default_rng(1)
    for r in found:
        reg = r.spec.params["regParam"]

        def objective(w):
            m = sign * (x @ w)
            return (np.log1p(np.exp(-m)) if r.spec.name == "logistic" else np.maximum(0, 1 - m)).mean() + reg / 2 * w @ w
        assert np.isclose(objective(r.weights), r.value) and -1e-9 <= r.gap <= 1e-6 * r.value and r.steps < 100
        for scale in (1e-3, 1e-2, 0.1, 1.0):
            for _ in range(20):
                assert objective(r.weights + scale * rng.normal(size=4)) >= r.bound - 1e-12
    train = frame.where(~F.col("is_test")).select("features", F.col("y1").alias("label"))
    for r in found[:2]:
        other = tr.fit("logistic", train, override={"regParam": r.spec.params["regParam"], "convergenceTol": 1e-10}).coefficients()
        assert np.allclose(r.weights, other, atol=0.02)
    with pytest.raises(ValueError):
        fit_optimal(blocks, [Spec("logistic", 0, {"regParam": 0.0})])


def test_plane_model_equals_a_grid():
    planes = _Planes(0.5)
    rng = np.random.default_rng(2)
    for _ in range(6):
        planes.add(rng.normal(size=1), rng.normal())
    w, value = planes.solve()
    grid = np.linspace(-10, 10, 200_001)
    all_ = np.max([s[0] * grid + o for s, o in zip(planes.slopes, planes.offsets)], axis=0) + 0.25 * grid**2
    assert abs(value - all_.min()) < 1e-4 and abs(w[0] - grid[all_.argmin()]) < 1e-3  # the grid misses the kink a little


@pytest.mark.parametrize("name,label,params", [
    ("logistic", 0, {"step": 1.0, "regParam": 0.01, "regType": "l2", "iterations": 30, "convergenceTol": 1e-4}),
    ("logistic", 0, {"step": 0.5, "regParam": 0.01, "regType": "l1", "iterations": 30, "convergenceTol": 0.0}),
    ("svm", 0, {"step": 0.5, "regParam": 0.005, "regType": None, "iterations": 25, "convergenceTol": 0.0}),
    ("linear", 1, {"step": 1.0, "iterations": 10, "convergenceTol": 1e-4, "initialWeights": [1.0, 0.0, 0.0, 2.0]}),
    ("ridge", 1, {"step": 0.3, "regParam": 0.1, "iterations": 500, "convergenceTol": 0.01}),
    ("lasso", 1, {"step": 1.0, "regParam": 0.05, "iterations": 12, "convergenceTol": 0.0, "intercept": True}),
])
def test_descent_equals_numpy(blocks, data, name, label, params):
    x, y = train_of(data, label, name in ("logistic", "svm"))
    if params.get("intercept"):
        x = np.hstack([x, np.ones((len(x), 1))])
    w = np.array(params.get("initialWeights", np.zeros(x.shape[1])), dtype=float)
    kind = {"ridge": "l2", "lasso": "l1", "linear": None}.get(name, params.get("regType"))
    done = 0
    for i in range(1, params["iterations"] + 1):
        m = x @ w
        if name == "logistic":
            slope = 1 / (1 + np.exp(-m)) - y
        elif name == "svm":
            slope = np.where(1 - (2 * y - 1) * m > 0, -(2 * y - 1), 0.0)
        else:
            slope = m - y
        g, size, old, done = x.T @ slope / len(x), params["step"] / np.sqrt(i), w, i
        w = w * (1 - size * params.get("regParam", 0.0)) - size * g if kind == "l2" else w - size * g
        if kind == "l1":
            w = np.sign(w) * np.maximum(np.abs(w) - size * params["regParam"], 0)
        if i > 1 and np.linalg.norm(w - old) < params["convergenceTol"] * max(np.linalg.norm(w), 1):
            break
    (got,) = fit_descent(blocks, [Spec(name, label, params)])
    assert got.steps == done and np.allclose(got.weights, w)


def test_many_fits_share_their_passes(blocks, monkeypatch):
    passes, real = [], type(blocks).summed
    monkeypatch.setattr(type(blocks), "summed", lambda self, f: passes.append(1) or real(self, f))
    specs = [Spec(t, 0, {"step": s, "regParam": r, "iterations": 6, "convergenceTol": 0.0})
             for t in ("logistic", "svm") for s in (0.5, 1.0) for r in (0.01, 0.005)]
    found = fit_descent(blocks, specs)
    assert len(found) == 8 and len(passes) == 7  # one for the width, then one a step
    alone = [fit_descent(blocks, [s])[0].weights for s in specs[:2]]
    assert all(np.allclose(a, b.weights) for a, b in zip(alone, found))


def test_mini_batches_repeat_and_cover_their_share(blocks):
    spec = Spec("logistic", 0, {"miniBatchFraction": 0.25, "iterations": 5, "convergenceTol": 0.0, "regParam": 0.01})
    (a,), (b,) = fit_descent(blocks, [spec]), fit_descent(blocks, [spec])
    assert np.array_equal(a.weights, b.weights)
    (n, _, _), = losses_and_gradients(blocks, [spec], [np.zeros(4)], step=3)
    everything = losses_and_gradients(blocks, [Spec("logistic", 0)], [np.zeros(4)])[0][0]
    assert 0.18 < n / everything < 0.32


def test_moments_and_least_squares_equal_numpy(blocks, data):
    sums = moments(blocks)
    x, y = train_of(data, 1)
    m = sums[1]
    assert m.n == len(x) and np.allclose(m.gram, x.T @ x) and np.allclose(m.xy, x.T @ y) and np.isclose(m.yy, y @ y)
    linear, ridge, ridge1, lasso = fit_least_squares(m, [
        ("linear", {}), ("ridge", {"regParam": 0.1}), ("ridge", {"regParam": 0.1, "intercept": True}), ("lasso", {"regParam": 0.05})])
    assert np.allclose(linear.weights, np.linalg.lstsq(x, y, rcond=None)[0])
    assert np.allclose(ridge.weights, np.linalg.solve(x.T @ x + 0.1 * len(x) * np.eye(4), x.T @ y))
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + 0.1 * len(x) * np.eye(4), xc.T @ yc)
    assert np.allclose(ridge1.weights, w) and np.isclose(ridge1.intercept, y.mean() - x.mean(axis=0) @ w)
    g = x.T @ (x @ lasso.weights - y) / len(x)  # optimality: |g| <= penalty, = -sign where w is not 0
    on = lasso.weights != 0
    assert np.allclose(g[on], -0.05 * np.sign(lasso.weights[on]), atol=1e-9) and (np.abs(g) <= 0.05 + 1e-9).all()


def test_lasso_path_and_degenerate_sums():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(50, 6))
    x[:, 5] = 0.0
    y = x @ [2, 0, -1, 0, 0.1, 9]
    m = Moments(50, x.T @ x, x.T @ y, y @ y, x.sum(axis=0), y.sum())
    path = lasso_path(m, [0.01, 10.0, 0.5])
    assert not path[10.0].any() and path[0.5][5] == 0 and np.allclose(path[0.01][[0, 2]], [2, -1], atol=0.1)
    twice = Moments(50, np.kron(np.ones((2, 2)), m.gram), np.tile(m.xy, 2), m.yy, np.tile(m.x, 2), m.y)
    (w,) = fit_least_squares(twice, [("linear", {})])
    assert np.allclose(w.weights[:6], w.weights[6:])
    with pytest.raises(ValueError):
        fit_least_squares(Moments(0, m.gram * 0, m.xy * 0, 0, m.x * 0, 0), [("linear", {})])


def test_partial_sums_equal_the_metrics_of_all_pairs(spark, blocks, frame):
    models = [scoring.Predictor("linear", np.array([1.0, 2.0, 3.0, 4.0]), 1e6),
              scoring.Predictor("sign", np.array([1.0, -1.0, 0.0, 0.2]), 0.1),
              scoring.Predictor("classes", np.array([[1.0, 0, 0, 0], [0, 1.0, 0, 0], [0, 0, 1.0, 1.0]]), np.zeros(3), np.array([-1.0, 0.5, 2.0])),
              scoring.Predictor("steps", np.array([[0.1, 0.3, 0.6], [1.0, 2.0, 5.0]]), feature=2)]
    got = {r.fit: r for r in scoring.score_models(blocks, models, [1, 0, 1, 0], [False, True, False, False]).collect()}
    pairs = []
    for r in frame.where("is_test").collect():
        x = r.features.toArray()
        p = [x @ [1, 2, 3, 4] + 1e6, float(x @ [1, -1, 0, 0.2] + 0.1 > 0), [-1.0, 0.5, 2.0][int(np.argmax([x[0], x[1], x[2] + x[3]]))],
             float(np.interp(x[2], [0.1, 0.3, 0.6], [1.0, 2.0, 5.0]))]
        y = [r.y2, float(r.y1 > 0), r.y2, r.y1]
        pairs += [(i, float(a), b) for i, (a, b) in enumerate(zip(p, y))]
    want = regression_metrics(spark.createDataFrame(pairs, "fit int, prediction double, label double"), group_by=["fit"]).collect()
    for w in want:
        g = got[w.fit]
        assert g.n == w.n
        for c in ("var", "mae", "mse", "r2", "rmse"):
            assert np.isclose(g[c], w[c], rtol=1e-9), (w.fit, c)


def test_parts_without_rows_and_constant_labels(spark):
    df = spark.createDataFrame([(Vectors.dense(1.0), 2.0, True), (Vectors.dense(3.0), 2.0, True), (Vectors.dense(3.0), 1.0, False)],
                               ["features", "y", "is_test"])
    b = to_blocks(df, "features", {"y": F.col("y"), "none": F.lit(None)}, F.col("is_test"))
    model = scoring.Predictor("linear", np.array([1.0]))
    a, none = sorted(scoring.score_models(b, [model, model], [0, 1], [False, False]).collect(), key=lambda r: r.fit)
    assert (a.n, a.r2, a.mae) == (2, None, 1.0) and (none.n, none.mse) == (0, None)
    b.unpersist()


def test_three_ways_to_fit_agree(spark, data):
    x, y, _ = data
    rows = [(i, float(b[0]), *map(float, a)) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "k long, y double, a double, b double, c double, d double")
    prep = mr.prepare(df, ["y"], ["a", "b", "c", "d"], ["k"], use_components=False, partitions=3)
    assert prep.rows.rdd.getNumPartitions() == 3
    plan = [(t, "y", 0, {"regParam": 0.01}) for t in ("logistic", "svm", "linear", "ridge", "lasso")] + [("naive_bayes", "y", 0, {}), ("isotonic", "y", 0, {})]
    shared = {r.trainer: r for r in mr.evaluate(prep, plan).collect()}
    ml = {r.trainer: r for r in mr.evaluate(prep, plan, optimizer="ml").collect()}
    assert {r.n for r in shared.values()} == {prep.rows.where("is_test").count()}
    for t in shared:
        assert abs(shared[t].mse - ml[t].mse) < 0.02, t
    with pytest.raises(ValueError):
        mr.evaluate(prep, plan, optimizer="other")
    prep.unpersist()


def test_training_rows_leave_out_held_out_and_unlabelled():
    block = (np.arange(8.0).reshape(4, 2), np.array([[1.0], [np.nan], [-2.0], [3.0]]), np.array([False, False, False, True]))
    x, y = training_rows(block, 0)
    assert x.tolist() == [[0, 1], [4, 5]] and y.tolist() == [1, -2]
    assert training_rows(block, 0, positive=True)[1].tolist() == [1, 0]
