"""Hold-out split (M2) and split ratio (A2).

``key_split`` decides train/test from a row key with integer arithmetic,
so the answer does not depend on partitioning, task order or retries (a
lost executor recomputes the same rows on the same side). ``random_split``
keeps Spark's own ``randomSplit`` for callers that want it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Mersenne prime 2^31 - 1: keys are reduced modulo it, so the product with a
# multiplier below it fits in a signed 64-bit integer (no overflow in ANSI
# mode).
MODULUS = 2147483647
MULTIPLIER = 1103515245
INCREMENT = 12345


def split_unit(key: Column, seed: int = 0) -> Column:
    """A number in [0, 1) from an integer key: ``((k mod P) * A + B + seed)
    mod P / P``."""
    k = F.pmod(key.cast("long"), F.lit(MODULUS))
    h = F.pmod(k * F.lit(MULTIPLIER) + F.lit(INCREMENT + int(seed)), F.lit(MODULUS))
    return h.cast("double") / F.lit(float(MODULUS))


def row_key(columns: Sequence[str]) -> Column:
    """One integer key from any columns: the column itself when it is a
    single integral column, else ``xxhash64`` of them."""
    if len(columns) == 1:
        return F.col(columns[0])
    return F.xxhash64(*[F.col(c) for c in columns])


def key_split(df: DataFrame, key_columns: Sequence[str], test_fraction: float = 0.3,
              seed: int = 0, flag: str = "is_test", integral_key: bool = True) -> DataFrame:
    """Add a boolean ``flag`` column: True for the test share. Rows with a
    null key train."""
    if not 0.0 <= test_fraction <= 1.0:
        raise ValueError("test_fraction must be within [0, 1]")
    key = row_key(key_columns) if integral_key else F.xxhash64(*[F.col(c) for c in key_columns])
    side = split_unit(key, seed) < F.lit(float(test_fraction))
    return df.withColumn(flag, F.coalesce(side, F.lit(False)))


def random_split(df: DataFrame, train_share: float = 0.7, seed: int | None = None):
    """Spark's ``randomSplit`` (depends on partitioning even with a seed)."""
    return df.randomSplit([train_share, 1.0 - train_share], seed)


def split_counts(df: DataFrame, flag: str = "is_test") -> DataFrame:
    """A2: total rows, test rows and test share in one pass (one row)."""
    return df.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.sum(F.when(F.col(flag), 1).otherwise(0)).cast("long").alias("n_test"),
    ).select(
        "n_total", "n_test",
        F.round(F.col("n_test") / F.col("n_total"), 6).alias("test_ratio"))
