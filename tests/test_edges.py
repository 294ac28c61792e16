"""Edge cases and partition invariance (survey section 5, items 5 and 6)."""

import os
import warnings

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from fixtures import write_raw
from tablefit.operators import trainers as tr
from tablefit.operators.components import fit_components
from tablefit.operators.exclude import exclusion_list
from tablefit.plans import model_run as mr
from tablefit.plans.tables import LINEITEM_FEATURES, lineitem_matches
from tablefit.sources.csv_tables import collate


def test_empty_file_set(spark, tmpdir_path):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        with pytest.raises(ValueError, match="no match files"):
            collate(spark, tmpdir_path, 2000, 2002, exclusion_list())


def test_header_only_file(spark, tmpdir_path):
    root = write_raw(tmpdir_path)
    os.makedirs(os.path.join(root, "0203"))
    with open(os.path.join(root, "0203", "E1.csv"), "w") as f:
        f.write("Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,HTHG,HTAG,HTR,WHH,WHD,WHA\n")
    col = collate(spark, root, 2000, 2003, exclusion_list())
    assert {"WHH", "WHD", "WHA"} <= set(col.titles)
    assert col.table.where(F.col("start_year") == 2002).count() == 0
    assert col.table.count() == 6


def test_one_class_only(spark):
    from tablefit.functions.vectors import to_vector
    df = spark.createDataFrame([(1.0, [float(i % 3), 1.0]) for i in range(20)],
                               "label double, f array<double>").select(
        "label", to_vector("f").alias("features"))
    nb = tr.BayesFromStatistics("naive_bayes", {"lambda_": 1.0},
                                tr.bayes_statistics(df, "features", "label"))
    preds = {r[0] for r in nb.add_prediction(df, "p").select("p").collect()}
    assert preds == {1.0}


def test_k_above_width_is_capped(spark):
    df = spark.createDataFrame([([float(i), float(i % 5), float(i % 7)],) for i in range(40)],
                               "x array<double>")
    with pytest.warns(UserWarning, match="using 3"):
        c = fit_components(df, "x", None, k=9, confidence=0.5)
    assert c.k == 3


def _prepared_report(spark, parts):
    li = lineitem_matches(spark, SF001).repartition(parts)
    prep = mr.prepare(li, ["RF"], LINEITEM_FEATURES, ["row_key"], k=4)
    try:
        comps = prep.components
        test_keys = sorted(r[0] for r in prep.rows.where("is_test").select("row_key").collect())
        plan = [("naive_bayes", "RF", i, {"lambda_": lam}) for i, lam in enumerate([1.0, 1e-3])]
        rep = mr.evaluate(prep, plan, digits=9).orderBy("param_set").collect()
        return comps, test_keys, [(r["n"], r["mse"], r["mae"]) for r in rep]
    finally:
        prep.unpersist()


def test_same_answers_for_1_4_16_partitions(spark):
    results = [_prepared_report(spark, p) for p in (1, 4, 16)]
    base_c, base_keys, base_rep = results[0]
    for c, keys, rep in results[1:]:
        assert keys == base_keys
        np.testing.assert_allclose(c.eigenvalues, base_c.eigenvalues, atol=1e-9)
        np.testing.assert_allclose(c.vectors, base_c.vectors, atol=1e-7)
        assert rep == base_rep


def test_components_on_zero_rows(spark):
    df = spark.createDataFrame([(0.0, 1.0)], "a double, f double")
    rows = mr.normalised_rows(df, ["a"], ["f"])
    with pytest.raises(ValueError, match="no rows"):
        fit_components(rows, "x", ["f"], k=1)


def test_checkpointed_prepare_cuts_lineage(spark):
    li = lineitem_matches(spark, SF001)
    prep = mr.prepare(li, ["RF"], LINEITEM_FEATURES, ["row_key"], k=4, checkpoint=True)
    try:
        plan = prep.rows._jdf.queryExecution().executedPlan().toString()
        assert "lineitem.parquet" not in plan and "FileScan" not in plan
        assert "ExistingRDD" in plan or "Scan" in plan
        assert prep.rows.count() > 0
    finally:
        prep.unpersist()
