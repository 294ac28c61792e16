"""What the main run keeps while it fits: a table of cells and blocks on disk, nothing in the executors' memory."""
from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablefit.operators import blocks as bl
from tablefit.plans import model_run as mr
from tablefit.session import local_path

PLAN = [("logistic", "y", 0, {}), ("naive_bayes", "y", 0, {}), ("svm", "y - 3", 0, {})]


def _typed(spark):
    rows = [(i, str(i % 4), str(i % 7 - 3) if i % 5 else None, "x" if i % 11 == 0 else f"{(i * 37) % 13}.5", str(i % 3 - 1)) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, ys string, as string, bs string, cs string")
    return df.select("k", F.expr("try_cast(ys AS double)").alias("y"), *[F.expr(f"try_cast({c}s AS double)").alias(t)
                                                                       for c, t in (("a", "BbMx>2.5"), ("b", "a b,="), ("c", "c"))])


def _in_memory(spark):
    return [i for i, rdd in spark.sparkContext._jsc.getPersistentRDDs().items() if rdd.getStorageLevel().useMemory()]


def test_computed_rows_take_no_memory_and_give_the_same_report(spark, monkeypatch):
    df, features = _typed(spark), ["BbMx>2.5", "a b,=", "c"]
    before, seen, cells = set(_in_memory(spark)), [], []
    score = mr.score_models

    def watched(blocks, *args):
        seen.append(set(_in_memory(spark)) - before)
        return score(blocks, *args)

    def reports(**args):
        prep = mr.prepare(df, ["y"], features, ["k"], k=2, **args)
        try:
            cells.append(prep.cells)
            held = prep.rows.select("k", "y", "features", "is_test").orderBy("k").collect()
            return held, [r.asDict() for r in mr.evaluate(prep, PLAN).collect()]
        finally:
            prep.unpersist()

    monkeypatch.setattr(mr, "score_models", watched)
    rows, report = reports(computed=True, checkpoint=True)
    assert seen == [set()]
    assert cells[0] is not None and not os.path.exists(local_path(cells[0]))
    plain_rows, plain = reports(computed=False, persist=False)
    assert cells[1] is None
    assert [(r.k, r.y, r.is_test) for r in rows] == [(r.k, r.y, r.is_test) for r in plain_rows]
    np.testing.assert_allclose([r.features.toArray() for r in rows], [r.features.toArray() for r in plain_rows], atol=1e-12)
    for a, b in zip(report, plain, strict=True):
        assert all(a[c] == pytest.approx(b[c], abs=1e-9) for c in ("n", "test_ratio", "var", "mae", "mse", "r2", "rmse"))


def test_stored_cells_hold_the_rows_that_pass_once(spark):
    df = _typed(spark)
    stored, path = mr.store_cells(df, ["y"], ["BbMx>2.5", "a b,=", "c"], ["k"])
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "try_cast" not in plan and "FileScan parquet" in plan and os.path.exists(local_path(path))
    want = df.where("y <> 0 AND (`BbMx>2.5` <> 0 OR `a b,=` <> 0 OR c <> 0)")
    assert stored.columns == df.columns and stored.dtypes == df.dtypes
    assert sorted(map(str, stored.collect())) == sorted(map(str, want.collect()))


def test_blocks_are_held_on_disk_only(spark, monkeypatch):
    monkeypatch.setattr(bl, "BLOCK_VALUES", 20)
    df = spark.createDataFrame([(Vectors.dense(float(i), 1.0), float(i % 3), i % 4 == 0) for i in range(200)], ["features", "y", "t"])
    b = bl.to_blocks(df.coalesce(1), "features", {"y": F.col("y")}, F.col("t"))
    try:
        sums = b.summed(lambda parts: {0: sum((np.array([len(x), x[:, 0].sum()]) for x, _, _ in parts), np.zeros(2))})[0]
        assert sums.tolist() == [200.0, sum(range(200))]
        level = b.held.getStorageLevel()
        assert level.useDisk and not level.useMemory
        assert not b.frame.storageLevel.useMemory and not b.frame.storageLevel.useDisk
    finally:
        b.unpersist()
    assert not b.held.getStorageLevel().useDisk
