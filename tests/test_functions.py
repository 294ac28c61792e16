"""Cell, label and vector functions (P2-P7, V1-V3) on hand-worked cases."""

import math

import pytest
from pyspark.sql import types as T

from tablefit.functions.cells import category_value, typed_cell
from tablefit.functions.labels import check_label_expression, label_column, referenced_names
from tablefit.functions.vectors import (l1_abs_normalize, lp_normalize, max_abs_normalize,
                                        signed_max_normalize)

CELLS = [("2", 2.0), ("1.50", 1.5), ("-3", -3.0), ("1e2", 100.0), (" 2 ", 2.0), ("", None),
         ("None", None), ("Man United", None), ("19/08/00", None), ("H", 1.0), ("D", 0.0),
         ("A", -1.0), ("1d", None), ("NaN", None), ("Infinity", None), ("010", 10.0),
         (None, None), (".5", 0.5), ("+4.", 4.0)]


def test_typed_cells(spark):
    df = spark.createDataFrame([(t,) for t, _ in CELLS], "t string")
    got = [r[0] for r in df.select(typed_cell("t")).collect()]
    assert got == [v for _, v in CELLS]


def test_category_table_parameter(spark):
    df = spark.createDataFrame([("R",), ("N",), ("A",), ("x",)], "t string")
    got = [r[0] for r in df.select(category_value("t", {"R": 1, "N": 0, "A": -1})).collect()]
    assert got == [1.0, 0.0, -1.0, None]


def test_label_expressions(spark):
    df = spark.createDataFrame([(3.0, 1.0)], "FTHG double, FTAG double")
    assert df.select(label_column("FTAG - FTHG", df.columns)).head()[0] == -2.0
    assert df.select(label_column("FTAG - 0.5 * FTHG", df.columns)).head()[0] == -0.5
    assert referenced_names("abs(FTAG - FTHG) + 1e5") == ["FTAG", "FTHG"]
    with pytest.raises(ValueError, match="unknown column"):
        check_label_expression("FTAG - XX", df.columns)


VEC = [[3.0, 4.0], [-3.0, 4.0], [None, 2.0], [0.0, 0.0]]


def _run(spark, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VEC)],
                               T.StructType([T.StructField("i", T.IntegerType()),
                                             T.StructField("a", T.ArrayType(T.DoubleType()))]))
    return [r[0] for r in df.orderBy("i").select(fn("a")).collect()]


def _close(a, b):
    if a is None or b is None:
        return a is b
    return all((x is None and y is None) or math.isclose(x, y, abs_tol=1e-12)
               for x, y in zip(a, b)) and len(a) == len(b)


def test_l2(spark):
    got = _run(spark, lambda a: lp_normalize(a, 2.0))
    want = [[0.6, 0.8], [-0.6, 0.8], [0.0, 1.0], [0.0, 0.0]]
    assert all(_close(g, w) for g, w in zip(got, want))


def test_signed_max(spark):
    got = _run(spark, signed_max_normalize)
    want = [[0.75, 1.0], [-0.75, 1.0], [0.0, 1.0], [None, None]]
    assert all(_close(g, w) for g, w in zip(got, want))


def test_max_abs(spark):
    got = _run(spark, max_abs_normalize)
    want = [[0.75, 1.0], [-0.75, 1.0], [0.0, 1.0], [0.0, 0.0]]
    assert all(_close(g, w) for g, w in zip(got, want))


def test_l1_abs(spark):
    got = _run(spark, l1_abs_normalize)
    want = [[3 / 7, 4 / 7], [3 / 7, 4 / 7], [0.0, 1.0], [0.0, 0.0]]
    assert all(_close(g, w) for g, w in zip(got, want))


def test_l3_norm_is_one(spark):
    got = _run(spark, lambda a: lp_normalize(a, 3.0))
    assert math.isclose(sum(abs(x) ** 3 for x in got[0]), 1.0)


def test_fixture_v3_row(spark):
    # Ash-Birch without components: B365 part 1.5/11.5, 4/11.5, 6/11.5
    df = spark.createDataFrame([([1.5, 4.0, 6.0, None, None],)], "a array<double>")
    got = df.select(l1_abs_normalize("a")).head()[0]
    assert _close(got, [1.5 / 11.5, 4 / 11.5, 6 / 11.5, 0.0, 0.0])
