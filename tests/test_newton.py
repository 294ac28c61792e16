"""Fits by Newton's method, and the rows that a fit reads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefit.functions.vectors import l1_abs_normalize, lp_normalize, to_vector
from tablefit.operators import newton
from tablefit.operators import trainers as tr
from tablefit.plans import model_run as mr
from tablefit.plans import queries as q


def _train(spark, scale=1.0, n=400):
    rnd = np.random.default_rng(3)
    x = rnd.random((n, 3))
    x[:, 2] = 0.5 + scale * x[:, 2]  # nearly constant with a small scale
    score = x @ np.array([2.0, -1.0, 0.3])
    y = np.where(score > 1.0, 1, np.where(score > 0.4, 0, -1))
    rows = [(*map(float, a), float(b)) for a, b in zip(x, y)] + [(0.1, 0.2, 0.3, -0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, label double").repartition(3)
    return df.select(to_vector(F.array("a", "b", "c")).alias("features"), "label")


def _objective(w, x, k, reg):
    score = x @ w.T
    if len(w) == 1:
        score = np.hstack([np.zeros_like(score), score])
    top = score.max(axis=1)
    loss = np.log(np.exp(score - top[:, None]).sum(axis=1)) + top - score[np.arange(len(x)), k]
    return loss.mean() + reg / 2 * (w * w).sum()


@pytest.mark.parametrize("name", ["logistic", "multinomial"])
@pytest.mark.parametrize("scale", [1.0, 1e-5])
def test_newton_is_at_the_minimum_in_few_passes(spark, monkeypatch, name, scale):
    passes = []
    one_pass = newton.Blocks.summed
    monkeypatch.setattr(newton.Blocks, "summed", lambda self, f: passes.append(1) or one_pass(self, f))
    train = _train(spark, scale).persist()
    fitted = tr.fit(name, train, optimizer="newton")
    assert len(passes) <= 8
    rows = train.collect()
    x = np.array([r["features"].toArray() for r in rows])
    y = np.array([r["label"] for r in rows])
    k = (y > 0).astype(int) if name == "logistic" else np.searchsorted(sorted(fitted.labels, key=str), y)
    if name == "multinomial":
        assert fitted.labels == [-1.0, 0.0, 1.0]
        k = np.array([fitted.labels.index(v + 0.0) for v in y])
    at = _objective(fitted.matrix, x, k, 0.01)
    rnd = np.random.default_rng(1)
    for size in (1e-2, 1e-4):
        for _ in range(20):
            assert at <= _objective(fitted.matrix + size * rnd.normal(size=fitted.matrix.shape), x, k, 0.01)
    tight = {"convergenceTol": 1e-12, "tolerance": 1e-12}
    other = tr.fit(name, train, override=tight).predict(train)
    own = fitted.predict(train)
    assert [r["prediction"] for r in own.collect()] == [r["prediction"] for r in other.collect()]
    train.unpersist()


def test_newton_takes_null_labels_and_one_class_as_the_ml_fit_does(spark):
    rows = [(0.2, 0.8, 1.0), (0.6, 0.4, None), (0.5, 0.5, -1.0), (0.9, 0.1, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    df = df.select(to_vector(F.array("a", "b")).alias("features"), "label")
    a = tr.fit("logistic", df, override={"convergenceTol": 1e-12}).coefficients()
    assert tr.fit("logistic", df, optimizer="newton").coefficients() == pytest.approx(a, abs=1e-6)
    one = df.where("label = 1")
    assert {r["prediction"] for r in tr.fit("multinomial", one, optimizer="newton").predict(df).collect()} == {1.0}
    with pytest.raises(ValueError, match="optimizer"):
        tr.fit("logistic", df, optimizer="other")
    # what Newton's method does not fit stays with the ML estimators
    assert isinstance(tr.fit("logistic", df, override={"regParam": 0.0}, optimizer="newton"), tr.Fitted)


def test_queries_fit_reads_the_persisted_rows_and_leaves_none(spark, monkeypatch):
    held = []
    fit = tr.fit
    monkeypatch.setattr(tr, "fit", lambda name, train, **k: held.append(
        "InMemoryTableScan" in train._jdf.queryExecution().executedPlan().toString()) or fit(name, train, **k))
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    out = q.logistic_fit(spark, "/root/testdata/sf0.001")
    assert held == [True]
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before
    assert out.count() > 0


def test_prepared_rows_are_held_until_released(spark):
    df = spark.createDataFrame([(i, float(i % 3 + 1), float(i % 5), float(i % 2 + 1)) for i in range(40)],
                               "k long, y double, a double, b double")
    prep = mr.prepare(df, ["y"], ["a", "b"], ["k"], k=2, persist=False)
    assert prep.base.storageLevel.useMemory
    prep.unpersist()
    assert not prep.base.storageLevel.useMemory
    assert mr.prepare(df, ["y"], ["a", "b"], ["k"], k=2).base is None


@pytest.mark.parametrize("normalise", [lambda c: lp_normalize(c, 2.0), l1_abs_normalize])
def test_a_row_norm_is_computed_once(spark, normalise):
    """One aggregate in the expression, outside the lambda over the elements."""
    df = spark.createDataFrame([([3.0, None, -4.0],), ([0.0, 0.0],)], "a array<double>")
    out = df.select(normalise(F.col("a")).alias("x"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1
    total = 5.0 if "sqrt" in plan.lower() else 7.0
    sign = -1 if total == 5.0 else 1
    assert [list(r["x"]) for r in out.collect()] == [[3 / total, 0.0, sign * 4 / total], [0.0, 0.0]]


def test_computed_columns_are_computed_once(spark):
    df = spark.createDataFrame([(1, "2", "3", "4"), (2, "0", "1", "1"), (3, None, "1", "1"), (4, "1", "0", None), (4, "x", "1", "1")],
                               "k long, ys string, as string, bs string")
    typed = df.select("k", *[F.expr(f"try_cast({c}s AS double)").alias(c) for c in "yab"])
    out = mr.normalised_rows(typed, ["y"], ["a", "b"], ["k"], computed=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as double") == 3
    assert out.collect() == mr.normalised_rows(typed, ["y"], ["a", "b"], ["k"]).collect()
    assert [(r["k"], list(r["x"])) for r in out.collect()] == [(1, [0.6, 0.8])]


def test_the_main_run_computes_its_cells_once(spark, monkeypatch):
    from tablefit.plans import main_run
    seen = []
    monkeypatch.setattr(main_run, "run_sweep", lambda *a, **k: seen.append(k["computed"]))
    col = type("C", (), {"inventory": None, "table": None, "titles": ["y"]})()
    monkeypatch.setattr(main_run, "collate_seasons", lambda *a, **k: col)
    monkeypatch.setattr(main_run, "assert_label_prefix", lambda *a: None)
    main_run.main_run(spark, "/none", labels=["y"])
    assert seen == [True]
