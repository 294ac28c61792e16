"""Operators against formulas, numpy and hand-worked tables."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import EXPECTED, MERGED
from tablefit.functions.fixed import LABELS
from tablefit.operators.align import (header_coverage, merged_titles, merged_titles_from_headers,
                                      union_by_name, unknown_columns)
from tablefit.operators.checks import (assert_label_prefix, drop_empty_features,
                                       drop_unusable_labels, label_prefix_report)
from tablefit.operators.components import (components_for_confidence, correlation_matrix,
                                           fit_components, sign_rule)
from tablefit.operators.exclude import exclude_columns, exclusion_list, kept_titles
from tablefit.operators.metrics import regression_metrics
from tablefit.operators.split import key_split, split_counts


def _merged_df(spark):
    schema = ", ".join(f"{c} double" for c in MERGED)
    return spark.createDataFrame(EXPECTED, schema)


def test_exclusion_list_sizes():
    assert len(exclusion_list()) == 27 + 15 + 7 + 9
    assert len(exclusion_list(False, False, False)) == 27
    from tablefit.functions.fixed import CATALOGUE
    assert len(CATALOGUE) == 100
    assert len(kept_titles(CATALOGUE, exclusion_list())) == 45


def test_exclude_ignores_absent(spark):
    df = _merged_df(spark)
    out = exclude_columns(df, ["GBH", "nope"])
    assert "GBH" not in out.columns and len(out.columns) == len(MERGED) - 1


def test_f1_f2(spark):
    df = _merged_df(spark)
    feats = [c for c in MERGED if c not in LABELS]
    kept = drop_empty_features(drop_unusable_labels(df, LABELS), feats)
    assert kept.count() == 4      # Cedar-Elm (zeros) and Cedar-Hazel (no features) go
    assert drop_unusable_labels(df, LABELS, drop_zero=False).count() == 6
    labels = sorted(r[0] for r in kept.select(F.col("FTAG") - F.col("FTHG")).collect())
    assert labels == [-3.0, -2.0, -1.0, 1.0]


def test_alignment(spark):
    inv = spark.createDataFrame(
        [("a/0001/E0.csv", "0001", 2000, LABELS + ["B365H", "B365D", "B365A"]),
         ("a/0102/E0.csv", "0102", 2001, LABELS + ["GBH", "GBD", "GBA", "XYZ"])],
        "file string, season string, start_year int, header array<string>")
    assert merged_titles(inv) == MERGED
    assert merged_titles_from_headers([LABELS + ["B365H", "B365D", "B365A"],
                                       LABELS + ["GBH", "GBD", "GBA", "XYZ"]]) == MERGED
    cov = {r["title"]: r["n_files"] for r in header_coverage(inv).collect()}
    assert cov["FTHG"] == 2 and cov["XYZ"] == 1
    assert [r["title"] for r in unknown_columns(inv).collect()] == ["XYZ"]
    rep = {r["file"]: r["ok"] for r in label_prefix_report(inv, LABELS).collect()}
    assert all(rep.values())
    assert_label_prefix(inv, LABELS)
    with pytest.raises(ValueError):
        assert_label_prefix(inv, ["FTAG"] + LABELS[1:])


def test_union_by_name_bag(spark):
    a = spark.createDataFrame([(1.0, 2.0), (1.0, 2.0)], "x double, y double")
    b = spark.createDataFrame([(3.0, 4.0)], "z double, x double")
    u = union_by_name([a, b], ["z", "x", "y"])
    assert u.columns == ["z", "x", "y"]
    assert sorted(u.collect(), key=str) == sorted(
        [(None, 1.0, 2.0), (None, 1.0, 2.0), (3.0, 4.0, None)], key=str)


def test_metrics_probe(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.5), (3.0, 7.0)], "prediction double, label double")
    m = regression_metrics(df).head()
    assert math.isclose(m["var"], 4.027777777, rel_tol=1e-6)
    assert math.isclose(m["mae"], 1.833333333, rel_tol=1e-6)
    assert math.isclose(m["mse"], 5.75, rel_tol=1e-9)
    assert math.isclose(m["r2"], -0.137362637, rel_tol=1e-6)
    assert math.isclose(m["rmse"], math.sqrt(5.75), rel_tol=1e-9)
    const = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0)], "prediction double, label double")
    assert regression_metrics(const).head()["r2"] is None


def test_metrics_match_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    rows = [(float(i % 7), float((i * 3) % 5)) for i in range(50)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    m = regression_metrics(df).head()
    for name in ["var", "mae", "mse", "r2", "rmse"]:
        ev = RegressionEvaluator(metricName=name).evaluate(df)
        assert math.isclose(m[name], ev, rel_tol=1e-9, abs_tol=1e-12), name


def test_key_split_invariant_to_partitioning(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "k")
    sides = []
    for n in (1, 4, 16):
        s = key_split(df.repartition(n), ["k"], 0.3)
        sides.append(sorted(r["k"] for r in s.where("is_test").collect()))
    assert sides[0] == sides[1] == sides[2]
    ratio = split_counts(key_split(df, ["k"], 0.3)).head()["test_ratio"]
    assert abs(ratio - 0.3) < 0.03


def _corr_rows(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    x[:, 1] = x[:, 0] * 0.8 + x[:, 1] * 0.3
    x[:, 3] = x[:, 2] * -0.5 + x[:, 3]
    x = np.abs(x) + 0.1
    xn = x / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(xn)],
                               "i long, x array<double>")
    return df, xn


def test_correlation_and_components_against_numpy(spark):
    df, xn = _corr_rows(spark)
    corr = correlation_matrix(df, "x")
    np.testing.assert_allclose(corr, np.corrcoef(xn.T), atol=1e-12)
    comps = fit_components(df, "x", ["a", "b", "c", "d"], k=4, confidence=0.999)
    vals, vecs = np.linalg.eigh(np.corrcoef(xn.T))
    order = np.argsort(-np.abs(vals))
    vals, vecs = vals[order], vecs[:, order]
    vecs = vecs * sign_rule(vecs)
    np.testing.assert_allclose(comps.eigenvalues, vals, atol=1e-9)
    np.testing.assert_allclose(comps.vectors, vecs, atol=1e-9)
    proj = comps.project(df, "x", ["i"]).orderBy("i").collect()
    got = np.array([[r[f"Comp{j + 1}"] for j in range(4)] for r in proj])
    np.testing.assert_allclose(got, xn @ vecs, atol=1e-9)
    # full rank keeps each row's L2 norm
    np.testing.assert_allclose(np.linalg.norm(got, axis=1), 1.0, atol=1e-9)


def test_components_confidence_override(spark):
    df, _ = _corr_rows(spark)
    with pytest.warns(UserWarning):
        c = fit_components(df, "x", None, k=1, confidence=0.99, override_components=True)
    assert c.k == c.k_confidence > 1
    with pytest.warns(UserWarning):
        c2 = fit_components(df, "x", None, k=1, confidence=0.99, override_components=False)
    assert c2.k == 1
    assert components_for_confidence([0.6, 0.3, 0.1], 0.85) == 2
    assert components_for_confidence([0.6, 0.3, 0.1], 1.0) == 3


def test_constant_feature_is_left_out(spark):
    df = spark.createDataFrame([([float(i), 1.0, float(i % 3)],) for i in range(30)],
                               "x array<double>")
    with pytest.warns(UserWarning, match="constant"):
        c = fit_components(df, "x", ["a", "b", "c"], k=3, confidence=0.5)
    assert c.constant == ["b"]
    assert math.isclose(float(np.sum(c.ratios)), 1.0)
