"""Repair and drop reports, components of wide rows, seasons, the import guard."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fixtures import write_raw
from tablefit.functions.fixed import CATALOGUE
from tablefit.operators.checks import drop_empty_features, drop_unusable_labels, observed_filters
from tablefit.operators.components import fit_components
from tablefit.operators.exclude import exclusion_list
from tablefit.operators.range_components import fit_range_components
from tablefit.sources.csv_tables import cells_in, collate
from tablefit.sources.seasons import seasons


def test_repair_report_counts_in_the_same_parse(spark, tmpdir_path):
    root = write_raw(tmpdir_path)
    col = collate(spark, root, 2000, 2002, exclusion_list(), catalogue=CATALOGUE, report=True)
    assert "width_repaired" not in col.table.columns and "_cells_off" not in col.table.columns
    col.table.write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in col.repair_report().orderBy("start_year").collect()] == [(2000, 3, 0, 0, 0), (2001, 3, 1, 1, 0)]
    plain = collate(spark, root, 2000, 2002, exclusion_list(), catalogue=CATALOGUE)
    assert plain.table.columns == col.table.columns
    with pytest.raises(ValueError):
        plain.repair_report()


def test_blank_rows_and_quoted_commas(spark, tmp_path):
    (tmp_path / "0001").mkdir()
    (tmp_path / "0001" / "a.csv").write_text('FTHG,FTAG,Note\n1,2,"a, b, c"\n,,x\n1\n3,4,"q",5\n"","",""\n')
    col = collate(spark, str(tmp_path), 2000, 2001, ["Note"], report=True, audit=True)
    col.table.write.format("noop").mode("overwrite").save()
    assert [tuple(r) for r in col.repair_report().collect()] == [(2000, 5, 1, 1, 2)]
    assert "width_repaired" in col.table.columns
    lines = spark.createDataFrame([('a,"b,c",d',), ("",), ("x,,",), ('"a ""q, r"" b",2',)], "line string")
    assert [r[0] for r in lines.select(cells_in(F.col("line"))).collect()] == [3, 1, 3, 2]


def test_drop_report_equals_the_filters(spark):
    rows = [(1.0, 1.0, 0.0), (0.0, 1.0, 1.0), (None, 1.0, 1.0), (2.0, 0.0, None), (2.0, None, None), (3.0, 0.0, 5.0)]
    df = spark.createDataFrame(rows, "y double, a double, b double")
    for drop_zero in (True, False):
        kept, seen = observed_filters(df, ["y"], ["a", "b"], drop_zero)
        want = drop_empty_features(drop_unusable_labels(df, ["y"], drop_zero), ["a", "b"])
        assert sorted(map(str, kept.collect())) == sorted(map(str, want.collect()))
        assert seen.get == {"n_rows": 6, "n_unlabelled": 2 if drop_zero else 1, "n_featureless": 2, "n_kept": 2 if drop_zero else 3}


def wide(spark, n, d, rank, seed=0):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, rank)) * 2.0 ** -np.arange(rank)) @ rng.normal(size=(rank, d)) + rng.normal(size=(n, d)) * 0.02 + 3.0
    return x, spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "k long, x array<double>").repartition(4)


def test_first_components_equal_the_dense_ones(spark):
    x, df = wide(spark, 400, 64, 6)
    names = [f"f{i}" for i in range(64)]
    got = fit_range_components(df, "x", names, 4)
    dense = fit_components(df, "x", names, k=4, confidence=0.1, override_components=False)
    assert np.allclose(got.vectors, dense.vectors[:, :4], atol=1e-6)
    assert np.allclose(got.eigenvalues, dense.eigenvalues[:4]) and np.allclose(got.ratios, dense.ratios[:4])
    rows = {r.k: [r.Comp1, r.Comp2, r.Comp3, r.Comp4] for r in got.project(df, "x", ["k"]).collect()}
    assert all(np.allclose(rows[i], x[i] @ got.vectors) for i in range(400))


def test_twenty_thousand_features_and_constant_ones(spark):
    x, df = wide(spark, 60, 20_000, 3)
    df = df.withColumn("x", F.concat(F.slice("x", 1, 19_999), F.array(F.lit(7.0))))
    names = [f"f{i}" for i in range(20_000)]
    got = fit_range_components(df, "x", names, 3)
    assert got.constant == ["f19999"] and not got.vectors[-1].any()
    z = (x[:, :-1] - x[:, :-1].mean(axis=0)) / x[:, :-1].std(axis=0)
    s = np.linalg.svd(z, compute_uv=False)[:3] ** 2 / len(x)
    assert np.allclose(got.eigenvalues, s, rtol=1e-6)
    assert np.allclose(got.vectors.T @ got.vectors, np.eye(3))
    with pytest.raises(ValueError):
        fit_range_components(df.limit(0), "x", names, 3)
    with pytest.raises(ValueError):
        fit_range_components(df, "x", names, 0)


def test_seasons_a_century_apart_are_refused():
    assert len(seasons("/r", 1950, 2050)) == 100
    with pytest.raises(ValueError, match="century"):
        seasons("/r", 1900, 2001)


def test_entry_works_without_the_other_queries(tmp_path):
    """In a copy without the training-data subpackage the rest imports and is registered."""
    import os
    import shutil
    import subprocess
    import sys
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copy(f"{here}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{here}/tablefit", tmp_path / "tablefit", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; assert 'collate_csv' in e.queries() and not any(q.startswith('op') and q[2].isdigit() for q in e.queries())"
    subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=tmp_path, check=True, timeout=120)
