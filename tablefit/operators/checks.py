"""Row filters and header checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def usable_labels_condition(labels: Sequence[str], drop_zero: bool = True) -> Column:
    """True when every label is present (and, by default, non-zero)."""
    parts = []
    for name in labels:
        c = _q(name)
        parts.append(c.isNotNull() & (c != 0) if drop_zero else c.isNotNull())
    return reduce(lambda a, b: a & b, parts)


def drop_unusable_labels(df: DataFrame, labels: Sequence[str], drop_zero: bool = True) -> DataFrame:
    """drop a row if any label is null, or zero when ``drop_zero``
    (zero counts as missing by default, which removes draws)."""
    return df.where(usable_labels_condition(labels, drop_zero))


def has_features_condition(features: Sequence[str]) -> Column:
    """Some feature is present and non-zero. Written as ``c IS NOT NULL AND
    c <> 0`` per feature (not ``coalesce(c, 0) <> 0``) so Parquet receives it
    as a pushed filter."""
    parts = [_q(f).isNotNull() & (_q(f) != 0) for f in features]
    if not parts:
        return F.lit(False)
    return reduce(lambda a, b: a | b, parts)


def drop_empty_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """drop a row whose features are all null or zero."""
    return df.where(has_features_condition(features))


def observed_filters(df: DataFrame, labels: Sequence[str], features: Sequence[str],
                     drop_zero: bool = True) -> tuple[DataFrame, Observation]:
    """F1 and F2 with a count of what they drop: the filtered rows, and an
    ``Observation`` whose ``get`` has, once an action has run, ``n_rows``,
    ``n_unlabelled`` (dropped by F1), ``n_featureless`` (of the others, dropped by
    F2) and ``n_kept``. Counted in the same pass; the filters then run above the
    count, so they are not pushed into the scan."""
    usable, filled = usable_labels_condition(labels, drop_zero), has_features_condition(features)
    usable, filled = F.coalesce(usable, F.lit(False)), F.coalesce(filled, F.lit(False))
    seen = Observation()
    watched = df.observe(
        seen, F.count(F.lit(1)).alias("n_rows"), F.count_if(~usable).alias("n_unlabelled"),
        F.count_if(usable & ~filled).alias("n_featureless"), F.count_if(usable & filled).alias("n_kept"))
    return watched.where(usable & filled), seen


def label_prefix_report(inventory: DataFrame, labels: Sequence[str],
                        header_col: str = "header", file_col: str = "file") -> DataFrame:
    """F3 on a header inventory: one row per file with the expected label
    block, the actual leading titles and whether they agree."""
    expected = F.array(*[F.lit(x) for x in labels])
    actual = F.slice(F.col(header_col), 1, len(labels))
    return inventory.select(
        F.col(file_col).alias("file"),
        expected.alias("expected"),
        actual.alias("actual"),
        (F.coalesce(actual == expected, F.lit(False))).alias("ok"))


def assert_label_prefix(inventory: DataFrame, labels: Sequence[str],
                        header_col: str = "header", file_col: str = "file") -> None:
    """Stop the run when any file's header does not start with the labels.
    Only the failing rows (bounded by the file count) reach the driver."""
    bad = (label_prefix_report(inventory, labels, header_col, file_col)
           .where(~F.col("ok")).orderBy("file").collect())
    if bad:
        lines = "\n".join(f"  {r['file']}: {r['actual']}" for r in bad)
        raise ValueError(f"header does not start with the labels {list(labels)}:\n{lines}")
