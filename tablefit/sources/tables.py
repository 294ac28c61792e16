"""Table sinks and scans.

The collated table is stored as Parquet partitioned by the integer
``start_year`` so a season range (S1) prunes directories; CSV with a header
is available for exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tablefit.sources.seasons import filter_seasons


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] = ("start_year",), mode: str = "overwrite") -> str:
    """Write a table. Partition columns must exist in ``df``."""
    parts = [c for c in partition_by if c in df.columns]
    w = df.write.mode(mode)
    if parts:
        w = w.partitionBy(*parts)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        w.option("header", True).csv(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    return path


def write_components(df: DataFrame, path: str, labels: Sequence[str], k: int,
                     prefix: str = "Comp", fmt: str = "parquet",
                     partition_by: Sequence[str] = ("start_year",)) -> str:
    """Labels + ``Comp1..Compk`` (plus the partition column)."""
    cols = list(labels) + [f"{prefix}{j + 1}" for j in range(k)]
    cols += [c for c in partition_by if c in df.columns and c not in cols]
    return write_table(df.select(*[f"`{c}`" for c in cols]), path, fmt, partition_by)


def read_table(spark: SparkSession, path: str, start_year: int | None = None,
               end_year: int | None = None, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """S9 (+ S1 pruning): scan a stored table, optionally only the seasons
    in [start_year, end_year)."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    elif fmt == "csv":
        r = spark.read.option("header", True)
        if schema is None:
            # season codes such as 0001 are text, whatever they look like
            found = r.option("inferSchema", True).csv(path).schema
            codes = {"season"} & set(found.names)
            schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in codes
                                                 else f.dataType, True) for f in found])
        df = r.schema(schema).csv(path)
    else:
        raise ValueError(f"unsupported format {fmt!r}")
    if start_year is not None and end_year is not None:
        df = filter_seasons(df, start_year, end_year)
    return df
