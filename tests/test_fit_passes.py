"""What a fit computes for each row: compiled expressions, one pass for few components."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablefit.functions.vectors import l1_abs_normalize, lp_normalize
from tablefit.operators import components as co
from tablefit.plans import queries as q

LINES = ("l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
         "l_tax double, l_returnflag string, l_linestatus string")


@pytest.fixture()
def tables(spark, tmp_path):
    rnd = np.random.default_rng(5)
    rows = [(i, i % 7, float(rnd.integers(1, 50)), float(rnd.random() * 1e5 + 900), float(rnd.random() / 10),
             float(rnd.random() / 12), "RNA"[i % 3], "FO"[i % 2]) for i in range(300)]
    spark.createDataFrame(rows, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_logistic_fit_deals_plain_rows_out_and_interprets_nothing(spark, tables):
    out = q.logistic_fit(spark, tables)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan
    assert "SQRT" in plan and plan.index("SQRT") < plan.index("Exchange hashpartitioning")
    assert 0 < out.count() < 200


@pytest.mark.parametrize("p", [1.0, 2.0, 3.0])
def test_written_out_norms_equal_the_general_ones(spark, p):
    rows = [([3.0, None, -4.0],), ([0.0, 0.0, -0.0],), ([1e-9, 1.0, 7.0],), ([None, None, None],)]
    df = spark.createDataFrame(rows, "a array<double>")
    got = df.select(lp_normalize("a", p, 3).alias("x"), lp_normalize("a", p).alias("y"),
                    l1_abs_normalize("a", 3).alias("u"), l1_abs_normalize("a").alias("v")).collect()
    assert len(got) == 4 and all(r["x"] == r["y"] and r["u"] == r["v"] for r in got)
    assert lp_normalize(F.col("a"), p, 10_000) is not None  # too wide to be written out


def test_few_components_come_from_one_pass(spark, monkeypatch):
    """The rows are read for the matrix once; nearly constant features, constant ones
    and partitions of any size or order don't change it."""
    monkeypatch.setattr(co, "StandardScaler", None)
    monkeypatch.setattr(co, "PCA", None)
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(500, 4))
    x[:, 1] = 1.0 + 1e-7 * (x[:, 0] + x[:, 1])
    x[:, 2] += np.arange(500) / 50
    x[:, 3] = 0.1
    for part in (1, 3, 600):
        df = spark.createDataFrame([([float(v) for v in r],) for r in x], "x array<double>").repartition(part)
        with pytest.warns(UserWarning, match="constant"):
            c = co.fit_components(df, "x", list("abcd"), k=3, confidence=0.1)
        assert c.constant == ["d"]
        values, vectors = np.linalg.eigh(np.corrcoef(x[:, :3].T))
        np.testing.assert_allclose(c.eigenvalues, [*values[::-1], 0.0], atol=1e-7)
        np.testing.assert_allclose(c.vectors[:3, :3], co.fix_signs(vectors[:, ::-1]), atol=1e-6)
        got = c.transform(df, "x", "y").collect()
        np.testing.assert_allclose([r["y"] for r in got], np.array([r["x"] for r in got]) @ c.vectors[:, :3], atol=1e-9)


def test_wide_rows_keep_the_fitted_model(spark):
    x = np.random.default_rng(4).random((60, co.FEW_FEATURES + 1))
    df = spark.createDataFrame([([float(v) for v in r],) for r in x], "x array<double>")
    c = co.fit_components(df, "x", None, k=2, confidence=0.01)
    assert c.model is not None
    got = c.transform(df, "x", "y").collect()
    np.testing.assert_allclose([r["y"] for r in got], x @ c.vectors[:, :2], atol=1e-9)
