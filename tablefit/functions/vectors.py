"""Feature arrays and vectors.

Arrays are normalised with SQL higher-order functions (JVM-side, no Python),
those of a known small width with an expression for each element, which Spark
compiles; vectors for ML go through ``array_to_vector`` and ``pyspark.ml.feature``
transformers.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.ml.functions import array_to_vector, vector_to_array

from tablefit.functions.cells import zero_if_null


#: Elements of an array at most whose normalisation is written out for each: the
#: expression has a term for each pair of them.
WRITTEN_OUT = 32


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def feature_array(columns: Sequence[str], fill_nulls: bool = True) -> Column:
    """All feature columns, in order, as ``array<double>`` (P7, with P5)."""
    parts = [zero_if_null(F.col(f"`{c}`")) if fill_nulls else F.col(f"`{c}`").cast("double")
             for c in columns]
    return F.array(*parts)


def fill_nulls_array(arr: str | Column) -> Column:
    """Null elements -> 0.0 (P5 on an array column)."""
    return F.transform(_col(arr), lambda x: F.coalesce(x.cast("double"), F.lit(0.0)))


def abs_array(arr: str | Column) -> Column:
    """|x| per element."""
    return F.transform(_col(arr), lambda x: F.abs(x))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, however often ``use``
    names it (inside a lambda it would be computed for every element)."""
    return F.transform(F.array(value), use)[0]


def lp_norm(arr: str | Column, p: float = 2.0) -> Column:
    """(sum |x|^p)^(1/p) of an array, nulls counted as 0."""
    return _norm(fill_nulls_array(arr), p)


def _norm(a: Column, p: float) -> Column:
    p = float(p)
    if p == 1.0:
        total = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.abs(x))
        return total
    if p == 2.0:
        total = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x * x)
        return F.sqrt(total)
    total = F.aggregate(a, F.lit(0.0), lambda acc, x: acc + F.pow(F.abs(x), F.lit(p)))
    return F.pow(total, F.lit(1.0 / p))


def _elements(arr: str | Column, width: int) -> list[Column]:
    return [F.coalesce(_col(arr)[i].cast("double"), F.lit(0.0)) for i in range(width)]


def _normalized_elements(values: Sequence[Column], p: float) -> Column:
    """The elements divided by their norm, summed up in the same order as ``_norm`` does."""
    total = F.lit(0.0)
    for x in values:
        total = total + (F.abs(x) if p == 1.0 else x * x if p == 2.0 else F.pow(F.abs(x), F.lit(p)))
    norm = total if p == 1.0 else F.sqrt(total) if p == 2.0 else F.pow(total, F.lit(1.0 / p))
    return F.array(*[F.when(norm == 0.0, x).otherwise(x / norm) for x in values])


def lp_normalize(arr: str | Column, p: float = 2.0, width: int | None = None) -> Column:
    """Row Lp normalisation with finite p (V1): ``x / ||x||_p``, nulls as 0,
    sign kept. A zero row stays zero (no division by zero). ``width``: the
    elements of every array, where they are known and no array is null."""
    if p == float("inf"):
        raise ValueError("use signed_max_normalize or max_abs_normalize for p = inf")
    if width is not None and 0 < width <= WRITTEN_OUT:
        return _normalized_elements(_elements(arr, width), float(p))
    return bound(fill_nulls_array(arr), lambda a: _divided(a, _norm(a, p)))


def _divided(a: Column, norm: Column) -> Column:
    return bound(norm, lambda n: F.when(n == 0.0, a).otherwise(F.transform(a, lambda x: x / n)))


def signed_max_normalize(arr: str | Column) -> Column:
    """Divide by the *signed* maximum element (V2); a zero maximum gives
    null elements instead of a division error."""
    return bound(fill_nulls_array(arr), lambda a: bound(
        F.array_max(a), lambda top: F.transform(a, lambda x: F.try_divide(x, top))))


def max_abs_normalize(arr: str | Column) -> Column:
    """The true L-infinity normalisation, ``x / max|x|``."""
    return bound(fill_nulls_array(arr), lambda a: _divided(a, F.array_max(abs_array(a))))


def l1_abs_normalize(arr: str | Column, width: int | None = None) -> Column:
    """V3: ``|x| / sum |x|`` with nulls as 0; an all-zero row stays all zero
    (its sparse form is empty). ``width``: as for :func:`lp_normalize`."""
    if width is not None and 0 < width <= WRITTEN_OUT:
        return _normalized_elements([F.abs(x) for x in _elements(arr, width)], 1.0)
    return lp_normalize(abs_array(fill_nulls_array(arr)), 1.0)


def to_vector(arr: str | Column) -> Column:
    return array_to_vector(_col(arr))


def to_array(vec: str | Column) -> Column:
    return vector_to_array(_col(vec), "float64")


def sparse_entries(df: DataFrame, arr: str, keep: Sequence[str] = (),
                   index_name: str = "idx", value_name: str = "value") -> DataFrame:
    """Long form of the non-zero entries of an array column (the sparse
    view of a feature row): one row per (keep..., idx, value)."""
    exploded = df.select(*[F.col(k) for k in keep], F.posexplode(_col(arr)).alias(index_name, value_name))
    return exploded.where(F.col(value_name) != 0.0)


def dense_entries(df: DataFrame, arr: str, keep: Sequence[str] = (),
                  index_name: str = "idx", value_name: str = "value") -> DataFrame:
    """Long form of every entry of an array column."""
    return df.select(*[F.col(k) for k in keep], F.posexplode(_col(arr)).alias(index_name, value_name))
