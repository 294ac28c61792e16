"""Trainers: closed forms, Spark-equivalence of the naive Bayes shortcut,
and properties of the iterative fits."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tablefit.functions.vectors import to_vector
from tablefit.operators import trainers as tr
from tablefit.plans import model_run as mr
from tablefit.plans.tables import (LINEITEM_EXPRESSIONS, LINEITEM_FEATURES, LINEITEM_LABELS,
                                   lineitem_matches)


def _one_feature(spark, n=300, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.uniform(0.1, 3.0, n)
    y = 0.7 * x + rng.normal(0, 0.3, n)
    df = spark.createDataFrame([([float(a)], float(b)) for a, b in zip(x, y)],
                               "f array<double>, label double")
    return df.select(to_vector("f").alias("features"), "label"), x, y


def test_linear_ridge_lasso_closed_forms(spark):
    df, x, y = _one_feature(spark)
    a, b, n = float(np.sum(x * x)), float(np.sum(x * y)), len(x)
    lam = 0.01
    assert math.isclose(tr.fit("linear", df).coefficients()[0], b / a, rel_tol=1e-9)
    assert math.isclose(tr.fit("ridge", df).coefficients()[0], b / (a + n * lam), rel_tol=1e-9)
    lasso = np.sign(b) * max(abs(b) - n * lam, 0) / a
    assert math.isclose(tr.fit("lasso", df).coefficients()[0], lasso, rel_tol=1e-7)


def _nb_data(spark):
    # each class leans on its own feature, so no two class scores are close
    rows = []
    for i in range(120):
        c = i % 3
        f = [1.0 + (i * 7) % 5, 1.0 + (i * 3) % 4, 1.0 + i % 2]
        f[c] += 6.0
        rows.append((float(c) - 1.0, f))
    df = spark.createDataFrame(rows, "label double, f array<double>")
    return df.select("label", to_vector("f").alias("features"))


def test_naive_bayes_formulas_and_shortcut(spark):
    df = _nb_data(spark)
    for lam in (1.0, 1e-3, 1e5):
        near_tie = lam > 100
        spark_nb = tr.fit("naive_bayes", df, override={"lambda_": lam})
        est = spark_nb.estimator_model
        short = tr.BayesFromStatistics("naive_bayes", {"lambda_": lam},
                                       tr.bayes_statistics(df, "features", "label"))
        np.testing.assert_allclose(short.pi, est.pi.toArray(), atol=1e-12)
        np.testing.assert_allclose(short.theta, est.theta.toArray(), atol=1e-12)
        a = spark_nb.predict(df).select("prediction").collect()
        b = short.add_prediction(df, "prediction").select("prediction").collect()
        if not near_tie:
            assert a == b
        assert spark_nb.labels == short.stats.labels


def test_naive_bayes_rejects_negative_features(spark):
    df = spark.createDataFrame([(1.0, [-1.0])], "label double, f array<double>").select(
        "label", to_vector("f").alias("features"))
    with pytest.raises(ValueError):
        tr.bayes_statistics(df, "features", "label")


@pytest.fixture(scope="module")
def prepared(spark):
    li = lineitem_matches(spark, SF001)
    prep = mr.prepare(li, LINEITEM_LABELS, LINEITEM_FEATURES, ["row_key"], k=4)
    yield prep
    prep.unpersist()


def test_logistic_gradient_near_zero(spark, prepared):
    data = mr.labelled(prepared, "RF").where(~F.col("is_test"))
    f = tr.fit("logistic", data, override={"convergenceTol": 1e-10})
    w = np.array(f.coefficients())
    pts = [(np.array(r["features"].toArray()), 1.0 if r["label"] > 0 else 0.0)
           for r in data.collect()]
    reg = 0.01
    grad = sum((1 / (1 + math.exp(-x @ w)) - y) * x for x, y in pts) / len(pts) + reg * w
    assert np.max(np.abs(grad)) < 1e-5


def test_svm_objective_no_worse_than_zero(spark, prepared):
    data = mr.labelled(prepared, "RF * LS").where(~F.col("is_test"))
    f = tr.fit("svm", data)
    w = np.array(f.coefficients())
    pts = [(np.array(r["features"].toArray()), 1.0 if r["label"] > 0 else -1.0)
           for r in data.collect()]

    def objective(v):
        return sum(max(0.0, 1 - y * (x @ v)) for x, y in pts) / len(pts) + 0.005 * v @ v
    assert objective(w) <= objective(np.zeros_like(w)) + 1e-12


def test_isotonic_is_monotone_and_matches_pav(spark):
    rng = np.random.default_rng(5)
    x = rng.uniform(0, 10, 200)
    y = np.sqrt(x) + rng.normal(0, 0.5, 200)
    df = spark.createDataFrame([([float(a)], float(b)) for a, b in zip(x, y)],
                               "f array<double>, label double").select(
        to_vector("f").alias("features"), "label")
    pred = tr.fit("isotonic", df).predict(df).select("features", "prediction").collect()
    pairs = sorted((r["features"][0], r["prediction"]) for r in pred)
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(pairs, pairs[1:]))
    # brute-force pool-adjacent-violators on the sorted points
    order = np.argsort(x)
    blocks = []
    for v in y[order]:
        blocks.append([v, 1])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] > blocks[-1][0] / blocks[-1][1]:
            s, c = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += c
    fitted = np.concatenate([[s / c] * c for s, c in blocks])
    np.testing.assert_allclose([p for _, p in pairs], fitted, atol=1e-9)


def test_multinomial_decodes_labels(spark, prepared):
    data = mr.labelled(prepared, "RF - LS")
    f = tr.fit("multinomial", data.where(~F.col("is_test")))
    preds = {r[0] for r in f.predict(data.where("is_test")).select("prediction").collect()}
    labels = {r[0] for r in data.select("label").distinct().collect()}
    assert preds <= labels


def test_sweep_has_92_rows_and_shared_fits(spark):
    li = lineitem_matches(spark, SF001)
    report = mr.run_sweep(li, LINEITEM_LABELS, LINEITEM_FEATURES, ["row_key"],
                          expressions=LINEITEM_EXPRESSIONS, k=4, parallelism=8)
    rows = report.collect()
    assert len(rows) == 92
    assert {r["trainer"] for r in rows} == {"logistic", "naive_bayes", "svm"}
    assert all(r["n"] and r["n"] > 0 for r in rows)
    # step has no ML counterpart: overrides differing only in step agree
    lr = {(r["label_expr"], r["param_set"]): r["mse"] for r in rows if r["trainer"] == "logistic"}
    for e in LINEITEM_EXPRESSIONS:
        assert lr[(e, 1)] == lr[(e, 2)]
        assert lr[(e, 0)] == lr[(e, 3)]


def test_unknown_label_name(spark, prepared):
    with pytest.raises(ValueError, match="unknown column"):
        mr.labelled(prepared, "RF - XX")


def test_zero_rows_after_filters(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "a double, f double")
    rows = mr.normalised_rows(df, ["a"], ["f"])
    assert rows.count() == 0


def test_sgd_path_scores_like_the_legacy_model(spark, prepared):
    from pyspark.mllib.linalg import Vectors as OldVectors
    from tablefit.operators.sgd import fit_sgd
    data = mr.labelled(prepared, "RF")
    f = fit_sgd("logistic", data.where(~F.col("is_test")), override={"iterations": 50})
    rows = f.predict(data.where("is_test")).select("features", "prediction").collect()
    from pyspark.mllib.classification import LogisticRegressionModel
    from pyspark.mllib.linalg import DenseVector
    legacy = LogisticRegressionModel(DenseVector(f.weights), f.intercept, 2, 2)
    for r in rows[:200]:
        assert float(legacy.predict(OldVectors.dense(r["features"].toArray()))) == r["prediction"]


def test_raw_scoring_differs_from_encoded(spark, prepared):
    plan = [("logistic", "RF", 0, {})]
    enc = mr.evaluate(prepared, plan, "encoded").head()
    raw = mr.evaluate(prepared, plan, "raw").head()
    assert enc["n"] == raw["n"]
    # 0/1 predictions against -1/1 labels: every class-0 row is off by at least 1
    assert raw["mae"] > enc["mae"]


def test_batched_bayes_scorer_matches_spark(spark):
    from pyspark.ml.functions import vector_to_array
    df = _nb_data(spark)
    stats = tr.bayes_statistics(df, "features", "label")
    lams = [1.0, 1e-3, 5.0]
    models = [tr.BayesFromStatistics("naive_bayes", {"lambda_": lam}, stats) for lam in lams]
    batch = df.select(tr.bayes_batch_predictions(
        models, vector_to_array("features", "float64")).alias("p")).collect()
    for j, lam in enumerate(lams):
        spark_nb = tr.fit("naive_bayes", df, override={"lambda_": lam})
        want = [r[0] for r in spark_nb.predict(df).select("prediction").collect()]
        assert [r["p"][j] for r in batch] == want


def test_concurrent_fits_equal_sequential(spark, prepared):
    plan = [("logistic", "RF", 0, {}), ("svm", "RF * LS", 0, {}),
            ("naive_bayes", "RF - LS", 0, {}), ("naive_bayes", "RF - LS", 1, {"lambda_": 1e-3})]
    one = sorted(tuple(r) for r in mr.evaluate(prepared, plan, parallelism=1).drop("params").collect())
    many = sorted(tuple(r) for r in mr.evaluate(prepared, plan, parallelism=8).drop("params").collect())
    assert one == many


def test_bayes_statistics_in_one_pass_equal_per_label(spark, prepared):
    data = prepared.rows.select("features", F.col("RF").alias("a"), (F.col("RF") - F.col("LS")).alias("b"))
    many = tr.bayes_statistics_many(data, "features", {"RF": "a", "RF - LS": "b"})
    for name, col in (("RF", "a"), ("RF - LS", "b")):
        one = tr.bayes_statistics(data, "features", col)
        assert many[name].labels == one.labels
        np.testing.assert_allclose(many[name].counts, one.counts)
        np.testing.assert_allclose(many[name].sums, one.sums, rtol=1e-12)


def test_overrides_start_from_fresh_defaults():
    first = tr.trainer_params("logistic", {"step": 0.5, "regParam": 0.005})
    again = tr.trainer_params("logistic", {})
    assert first["step"] == 0.5 and first["regParam"] == 0.005
    assert again["step"] == 1.0 and again["regParam"] == 0.01
    plan = mr.sweep_plan()
    assert len(plan) == 92
    assert sum(1 for t, *_ in plan if t == "naive_bayes") == 60
