"""Schema alignment over a header inventory.

A header inventory is a small DataFrame with one row per input file:
``file string, season string, start_year int, header array<string>``
(cleaned titles, in file order). Its size grows with the number of files,
never with the number of rows. Files share few headers, so titles are looked
at once per distinct header (``distinct_headers``, with its file count and its
first file); only title names are collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tablefit.functions.fixed import CATALOGUE


def distinct_headers(inventory: DataFrame, header_col: str = "header") -> DataFrame:
    """``header, n_files, first``: each header once, with its files and the
    (start_year, file) of the first of them. Files are grouped by a hash and
    the header itself, pre-aggregated in each task."""
    return (inventory.groupBy(F.xxhash64(header_col).alias("_hash"), F.col(header_col).alias("header"))
            .agg(F.count(F.lit(1)).alias("n_files"),
                 F.min(F.struct("start_year", "file")).alias("first")).drop("_hash"))


def title_order(inventory: DataFrame, header_col: str = "header") -> DataFrame:
    """U2 as a DataFrame: ``(title, position)``. The longest header comes
    first (the earliest file wins a tie), then every other title by first
    appearance, files taken in (start_year, file) order."""
    heads = distinct_headers(inventory, header_col)
    longest = heads.orderBy(F.size("header").desc(), "first").limit(1).select(F.col("first").alias("_longest"))
    flagged = heads.join(F.broadcast(longest), F.col("first") == F.col("_longest"), "left")
    exploded = flagged.select(
        F.when(F.col("_longest").isNotNull(), F.lit(0)).otherwise(F.lit(1)).alias("_rank0"),
        "first", F.posexplode("header").alias("pos", "title"))
    first = exploded.groupBy("title").agg(F.min(F.struct("_rank0", "first", "pos")).alias("_first"))
    return first.select(
        "title",
        # one row per distinct title: a global window over it is small
        F.row_number().over(Window.orderBy("_first")).alias("position"))


def merged_titles(inventory: DataFrame, header_col: str = "header") -> list[str]:
    """U2 as a list of names (bounded by the count of distinct titles)."""
    rows = title_order(inventory, header_col).orderBy("position").collect()
    return [r["title"] for r in rows]


def merged_titles_from_headers(headers: Sequence[Sequence[str]]) -> list[str]:
    """U2 for a few headers known on the driver, in file order."""
    longest = max(headers, key=len, default=[])
    return list(dict.fromkeys(t for h in [longest, *headers] for t in h))


def header_coverage(inventory: DataFrame, header_col: str = "header") -> DataFrame:
    """In how many files each title occurs."""
    heads = distinct_headers(inventory, header_col)
    return (heads.select(F.explode(F.array_distinct("header")).alias("title"), "n_files")
            .groupBy("title").agg(F.sum("n_files").alias("n_files")))


def catalogue_frame(spark: SparkSession, codes: Iterable[str] = CATALOGUE) -> DataFrame:
    schema = T.StructType([T.StructField("title", T.StringType(), False)])
    return spark.createDataFrame([(c,) for c in codes], schema)


def unknown_columns(inventory: DataFrame, catalogue: DataFrame | Sequence[str] | None = None,
                    header_col: str = "header") -> DataFrame:
    """U4: titles that are not in the catalogue, with the number of files
    that carry them. A catalogue given as a list (the fixed codes by
    default) has a known size and is broadcast; a catalogue DataFrame is
    joined as the planner sees fit."""
    cov = header_coverage(inventory, header_col)
    if catalogue is None or not isinstance(catalogue, DataFrame):
        codes = CATALOGUE if catalogue is None else list(catalogue)
        cat = F.broadcast(catalogue_frame(inventory.sparkSession, codes))
    else:
        cat = catalogue.select("title")
    return cov.join(cat, "title", "left_anti")


def union_by_name(frames: Sequence[DataFrame], order: Sequence[str] | None = None) -> DataFrame:
    """Stack frames with different columns; a column a frame lacks is
    null. Bag semantics (no de-duplication). ``order`` fixes the leading
    columns; columns not named there keep their union order after them."""
    if not frames:
        raise ValueError("nothing to union")
    # titles are matched exactly: Spark would take names that differ only in
    # case for one column, so the columns carry numbers during the union
    titles = list(dict.fromkeys(c for f in frames for c in f.columns))
    number = {t: f"_u{i}" for i, t in enumerate(titles)}
    numbered = [f.toDF(*[number[c] for c in f.columns]) for f in frames]
    out = numbered[0]
    for f in numbered[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    if order:
        titles = list(order) + [t for t in titles if t not in set(order)]
    return out.select(*[F.col(number[t]).alias(t) for t in titles])
