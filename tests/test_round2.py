"""Cases that earlier versions got wrong."""

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tablefit.functions.cells import typed_cell
from tablefit.functions.labels import label_column
from tablefit.operators import trainers as tr
from tablefit.operators.align import union_by_name
from tablefit.operators.metrics import regression_metrics
from tablefit.operators.split import key_split
from tablefit.sources.csv_tables import collate
from tablefit.sources.tables import read_table, write_table


def test_any_season_year_and_any_file_name(spark, tmp_path):
    root = tmp_path / "root with blank"
    for code, names in {"1415": ["E 0.csv", "E[0].csv"], "1617": ["E%200.csv", "a+b.csv", "E{1}.csv"]}.items():
        (root / code).mkdir(parents=True)
        for i, name in enumerate(names):
            (root / code / name).write_text(f"FTHG,FTAG\n{i},1\n{i},2\n")
    got = collate(spark, str(root), 2014, 2025)
    assert got.table.count() == 10 and got.inventory.count() == 5
    assert {r.start_year for r in got.table.select("start_year").distinct().collect()} == {2014, 2016}
    with pytest.raises(ValueError):
        collate(spark, str(root), 2014, 2025, max_year=2015)


def test_match_key_does_not_depend_on_the_location(spark, tmp_path):
    keys = []
    for place in ("a", "b"):
        (tmp_path / place / "0001").mkdir(parents=True)
        (tmp_path / place / "0001" / "E0.csv").write_text("FTHG,FTAG\n1,2\n3,4\n")
        keys.append(sorted(r.match_key for r in collate(spark, str(tmp_path / place), 2000, 2001).table.collect()))
    assert keys[0] == keys[1]


def test_audit_leaves_the_session_alone(spark, tmp_path):
    (tmp_path / "0001").mkdir()
    (tmp_path / "0001" / "E0.csv").write_text("FTHG,FTAG,X\n1,2,3\n1,2\n1,2,3,4\n")
    name = "spark.sql.csv.parser.columnPruning.enabled"
    before = spark.conf.get(name)
    got = collate(spark, str(tmp_path), 2000, 2001, excludes=["X"], audit=True).table.drop("match_key")
    assert sorted(r.width_repaired for r in got.collect()) == [False, True, True]
    assert spark.conf.get(name) == before


def test_multinomial_fits_its_classes_only_and_zero_has_one_sign(spark):
    rows = [(Vectors.dense(float(i % 3), 1.0), [-1.0, 0.0, -0.0, 2.0][i % 4]) for i in range(40)]
    df = spark.createDataFrame(rows, ["features", "label"])
    for name in ("multinomial", "naive_bayes"):
        fitted = tr.fit(name, df)
        assert fitted.labels == [-1.0, 0.0, 2.0] and fitted.estimator_model.numClasses == 3
        other = spark.createDataFrame([(Vectors.dense(1.0, 1.0), 7.0)], ["features", "label"])
        assert fitted.predict(other).first().prediction in fitted.labels
    assert tr.bayes_statistics(df, "features", "label").labels == [-1.0, 0.0, 2.0]


def test_isotonic_weights_equal_rows(spark):
    rows = [(Vectors.dense(9.0, float(x)), y) for x, y in [(1, 1.0), (1, 3.0), (2, 1.0), (3, 5.0), (3, 5.0), (3, 2.0), (4, 3.0)]]
    df = spark.createDataFrame(rows, ["features", "label"])
    fitted = tr.fit("isotonic", df, feature_index=1)
    got = {r.features[1]: r.prediction for r in fitted.predict(df).collect()}
    assert got == pytest.approx({1.0: 5 / 3, 2.0: 5 / 3, 3.0: 3.75, 4.0: 3.75})


def test_metrics_at_large_offsets_and_with_nulls(spark):
    shift = 1e9
    rows = [(shift + p, shift + y) for p, y in [(1.0, 2.0), (4.0, 3.0), (8.0, 7.5)]] + [(None, 5.0), (5.0, None)]
    got = regression_metrics(spark.createDataFrame(rows, "prediction double, label double")).first()
    near = regression_metrics(spark.createDataFrame([(p - shift, y - shift) for p, y in rows[:3]], "prediction double, label double")).first()
    assert got.n == 3 and got["var"] == pytest.approx(near["var"], abs=1e-5) and got.mae == pytest.approx(near.mae)
    none = regression_metrics(spark.createDataFrame([(None, 1.0)], "prediction double, label double")).first()
    assert none.n == 0 and none["var"] is None and none.mae is None


def test_titles_that_differ_in_case_stay_apart(spark):
    a = spark.createDataFrame([(1, 2)], ["FTHG", "B365H"])
    b = spark.createDataFrame([(3, 4)], ["FTHG", "b365h"])
    out = union_by_name([a, b])
    assert out.columns == ["FTHG", "B365H", "b365h"]
    assert sorted(map(tuple, out.collect())) == [(1, 2, None), (3, None, 4)]


def test_cells_labels_splits_and_codes(spark, tmp_path):
    df = spark.createDataFrame([("1e400", 1.0, 3.0, None), ("-2", 2.0, 1.0, 5)], "t string, `BbMx>2.5` double, x double, k long")
    assert [r[0] for r in df.select(typed_cell("t")).collect()] == [None, -2.0]
    assert [r[0] for r in df.select(label_column("BbMx>2.5 - x", df.columns)).collect()] == [-2.0, 1.0]
    assert [r[0] for r in df.select(label_column("`BbMx>2.5` * 2", df.columns)).collect()] == [2.0, 4.0]
    with pytest.raises(ValueError):
        label_column("BbMx>9 - x", ["x"])
    assert key_split(df, ["k"]).where(F.col("is_test").isNull()).isEmpty()
    table = spark.createDataFrame([("0001", 1.5), ("9900", None)], "season string, v double")
    write_table(table, str(tmp_path / "c"), "csv", ())
    back = read_table(spark, str(tmp_path / "c"), fmt="csv")
    assert sorted(r.season for r in back.collect()) == ["0001", "9900"] and dict(back.dtypes)["v"] == "double"


def test_sgd_settings_take_effect_for_every_trainer(spark):
    from tablefit.plans import model_run as mr

    rows = [(i, 1.0 if i % 3 else -1.0, float(i % 5) + 1, float(i % 7) + 1) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, y double, a double, b double")
    prep = mr.prepare(df, ["y"], ["a", "b"], ["k"], use_components=False)
    plan = [(t, "y", i, {"iterations": 3, "step": step}) for t in ("logistic", "svm", "linear", "ridge", "lasso")
            for i, step in enumerate((0.01, 1.0))]
    report = mr.evaluate(prep, plan, optimizer="sgd", parallelism=1).collect()
    assert len(report) == 10 and all(r.params["step"] in ("0.01", "1.0") for r in report)
    for trainer in ("linear", "ridge", "lasso"):
        assert len({r.mse for r in report if r.trainer == trainer}) == 2
    prep.unpersist()


def test_report_prints_each_entrys_own_parameters(spark):
    from tablefit.plans import model_run as mr

    rows = [(i, float(i % 2) - 0.5, float(i % 5) + 1, float(i % 7) + 1) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, y double, a double, b double")
    prep = mr.prepare(df, ["y"], ["a", "b"], ["k"], use_components=False)
    plan = [("logistic", "y", i, {"step": step}) for i, step in enumerate((0.5, 1.0))]
    report = mr.evaluate(prep, plan, parallelism=1).collect()
    assert {r.param_set: r.params["step"] for r in report} == {0: "0.5", 1: "1.0"}
    prep.unpersist()
