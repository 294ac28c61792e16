"""Cell functions (column expressions, all JVM-side).

- ``typed_cell``    text -> double: number, category value, or null (P2, P3)
- ``category_value`` text -> double through a category table (P3)
- ``zero_if_null``  null -> 0.0 (P5)
- ``absolute``      |x| (P6)
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablefit.functions.fixed import NUMBER_PATTERN, RESULT_CATEGORIES


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def category_value(c: str | Column,
                   categories: Mapping[str, float] = RESULT_CATEGORIES) -> Column:
    """Text that names a category -> its number; anything else -> null.
    A ``CASE`` chain: codegen-friendly and no map lookups per row."""
    return _category(F.trim(_col(c)), categories)


def _category(text: Column, categories: Mapping[str, float]) -> Column:
    out = None
    for key, value in categories.items():
        cond = text == F.lit(key)
        out = F.when(cond, F.lit(float(value))) if out is None else out.when(cond, F.lit(float(value)))
    if out is None:
        return F.lit(None).cast("double")
    return out.otherwise(F.lit(None).cast("double"))


def typed_cell(c: str | Column,
               categories: Mapping[str, float] = RESULT_CATEGORIES) -> Column:
    """Turn one text cell into a double.

    Only plain decimal/scientific numbers are numbers (``1d``, ``NaN`` and
    ``Infinity`` are not, although ``CAST`` would take them); leading zeros
    are decimal. Text that is not a number but is a category gets the
    category value; everything else (blank, names, dates) is null."""
    text = F.trim(_col(c))
    # the pattern first: a cast that fails costs far more than a pattern that
    # does not match. 1e400 is written like a number but too large for one.
    number = F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))
    return F.coalesce(F.when(F.abs(number) < F.lit(float("inf")), number), _category(text, categories))


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(_col(c).cast("double"), F.lit(0.0))


def absolute(c: str | Column) -> Column:
    return F.abs(_col(c))


def typed_columns(df, columns, categories: Mapping[str, float] = RESULT_CATEGORIES,
                  keep=()):
    """Project ``columns`` of ``df`` through :func:`typed_cell`; ``keep``
    columns pass through unchanged (first)."""
    return df.select(*[F.col(k) for k in keep],
                     *[typed_cell(F.col(f"`{c}`"), categories).alias(c) for c in columns])
