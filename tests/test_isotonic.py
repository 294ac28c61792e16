"""Distributed pool-adjacent-violators next to plain versions."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tablefit.operators import trainers as tr
from tablefit.operators.isotonic import boundary_edits, fit_isotonic, pooled
from tablefit.plans import model_run as mr


def plain(x, y):
    """Fitted value at each distinct x, by the max-min form."""
    xs = np.unique(x)
    s = np.array([y[x == v].sum() for v in xs])
    w = np.array([(x == v).sum() for v in xs], dtype=float)
    cs, cw = np.concatenate(([0], np.cumsum(s))), np.concatenate(([0], np.cumsum(w)))
    n = len(xs)
    fit = np.empty(n)
    for k in range(n):
        means = (cs[k + 1:, None] - cs[None, :k + 1]) / (cw[k + 1:, None] - cw[None, :k + 1])
        fit[k] = means.min(axis=0).max()
    return xs, fit


CASES = {
    "noisy rise": lambda rng: (rng.normal(size=400), None),
    "falling": lambda rng: (np.arange(300.0), -np.arange(300.0)),
    "rising": lambda rng: (np.arange(300.0), np.arange(300.0)),
    "ties": lambda rng: (rng.integers(0, 12, 500).astype(float), None),
    "one value holds a third": lambda rng: (np.where(rng.random(600) < 0.35, 5.0, rng.normal(5, 3, 600)), None),
    "low end swallows much": lambda rng: (np.arange(400.0), np.concatenate([np.linspace(0, 1, 200), [-900.0], np.linspace(0, 3, 199)])),
    "steps down": lambda rng: (np.arange(400.0), np.repeat([4.0, 3, 2, 1, 5, 4, 6, 2], 50) + rng.normal(size=400) * 0.01),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("partitions", [1, 7])
def test_blocks_equal_the_max_min_form(spark, name, partitions):
    rng = np.random.default_rng(7)
    x, y = CASES[name](rng)
    y = x * 0.5 + rng.normal(size=len(x)) if y is None else y
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    model = fit_isotonic(df, F.col("x"), F.col("y"), partitions=partitions)
    blocks = sorted(map(tuple, model.fitted().collect()))
    xs, fit = plain(x, y)
    got = np.array([next(v for lo, hi, v, _ in blocks if lo <= a <= hi) for a in xs])
    assert np.allclose(got, fit)
    assert sum(w for *_, w in blocks) == len(x)
    values = [v for _, _, v, _ in blocks]
    assert all(a <= b + 1e-12 for a, b in zip(values, values[1:]))


def test_predictions_equal_sparks_model(spark):
    rng = np.random.default_rng(8)
    rows = [(i, float(np.round(a, 1)), float(a * 0.3 + rng.normal())) for i, a in enumerate(rng.normal(size=800) * 3)]
    df = spark.createDataFrame(rows, "k long, x double, y double")
    test = spark.createDataFrame([(i, float(v)) for i, v in enumerate(np.linspace(-14, 14, 301))] + [(999, None)], "k long, x double")
    for increasing in (True, False):
        model = fit_isotonic(df, F.col("x"), F.col("y"), increasing, partitions=5)
        got = {r.k: r.p for r in model.predict(test, F.col("x"), "p").collect()}
        data = VectorAssembler(inputCols=["x"], outputCol="features").transform(df).withColumnRenamed("y", "label")
        spark_model = tr.fit("isotonic", data, override={"isotonic": increasing})
        scored = spark_model.predict(VectorAssembler(inputCols=["x"], outputCol="features").transform(test.where("x IS NOT NULL")))
        want = {r.k: r.prediction for r in scored.collect()}
        assert got.pop(999) is None and got.keys() == want.keys()
        assert np.allclose([got[k] for k in want], list(want.values()))


def test_null_rows_weights_and_other_columns(spark):
    df = spark.createDataFrame([(1.0, 3.0, 1.0), (2.0, 1.0, 3.0), (None, 9.0, 1.0), (3.0, None, 1.0), (4.0, 5.0, 0.0)], "x double, y double, part double")
    model = fit_isotonic(df, F.col("x"), F.col("y"), weight=F.col("part"), partitions=2)
    assert [tuple(r) for r in model.fitted().collect()] == [(1.0, 2.0, 1.5, 4.0)]
    out = model.predict(df, F.col("x")).collect()
    assert len(out) == 5 and {r.prediction for r in out if r.x is not None} == {1.5} and out[0].__fields__[-1] == "prediction"
    none = fit_isotonic(df.limit(0), F.col("x"), F.col("y"))
    assert none.fitted().count() == 0 and [r.prediction for r in none.predict(df.limit(1), F.col("x")).collect()] == [None]


def test_driver_sees_a_row_a_partition_and_rounds_are_few(spark):
    df = spark.range(20_000).select(F.col("id").cast("double").alias("x"), (F.col("id") / 1000 + F.rand(3) * 4).alias("y"))
    model = fit_isotonic(df, F.col("x"), F.col("y"), partitions=16)
    assert model.rounds <= 12 and model.frame.select("part").distinct().count() <= 16


def test_edits_merge_across_whole_partitions():
    b = lambda lo, s, w=1.0: {"lo": lo, "hi": lo, "s": s, "w": w}
    edges = [{"part": 0, "first": b(0, 1), "last": b(1, 5), "n": 2}, {"part": 2, "first": b(2, 4), "last": b(2, 4), "n": 1},
             {"part": 3, "first": b(3, 3), "last": b(4, 9), "n": 2}, {"part": 4, "first": b(5, 10), "last": b(5, 10), "n": 1}]
    left = boundary_edits(edges, True)
    assert left == [(0, False, True, False, 1, 3, 12.0, 3.0), (2, True, False, False, None, None, None, None),
                    (3, True, False, True, None, None, None, None)]
    assert boundary_edits(edges, False)[-1] == (3, True, False, True, 1, 3, 12.0, 3.0)
    assert boundary_edits(edges[2:], True) == []
    assert pooled(np.array([[0, 0, 2, 1], [1, 1, 1, 1], [2, 2, 0, 1.0]])).tolist() == [[0, 2, 3, 3]]


def test_sweep_scores_isotonic_without_collecting_blocks(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(v > 0) - 0.5, float(abs(v) + 0.1), float(abs(w) + 0.1)) for i, (v, w) in enumerate(rng.normal(size=(500, 2)))]
    df = spark.createDataFrame(rows, "k long, y double, a double, b double")
    prep = mr.prepare(df, ["y"], ["a", "b"], ["k"], use_components=False)
    (got,) = mr.evaluate(prep, [("isotonic", "y", 0, {})]).collect()
    (want,) = mr.evaluate(prep, [("isotonic", "y", 0, {})], optimizer="ml").collect()
    assert got.n == want.n and abs(got.mse - want.mse) < 1e-9 and abs(got.r2 - want.r2) < 1e-9
    prep.unpersist()
