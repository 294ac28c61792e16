"""The driver's Parquet tables and a match-like view of ``lineitem``.

``lineitem`` stands in for a collated match table: two result-like labels
from its flags (through category tables, as match results go through
H/D/A) and four numeric features.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.functions.cells import category_value
from tablefit.session import list_directories

# Category tables for the lineitem flags (returnflag like a match result).
RETURNFLAG_CATEGORIES = {"R": 1.0, "N": 0.0, "A": -1.0}
LINESTATUS_CATEGORIES = {"F": 1.0, "O": -1.0}

LINEITEM_KEYS = ["l_orderkey", "l_linenumber"]
LINEITEM_LABELS = ["RF", "LS"]
LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
LINEITEM_EXPRESSIONS = ["RF", "LS", "RF * LS", "RF - LS"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def lineitem_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``l_orderkey, l_linenumber, row_key, RF, LS, <features>``;
    ``row_key`` hashes the columns that are used, since (orderkey,
    linenumber) repeats; the scan reads no others."""
    li = table(spark, sf_dir, "lineitem")
    used = LINEITEM_KEYS + LINEITEM_FEATURES + ["l_returnflag", "l_linestatus"]
    return li.select(
        *[F.col(k) for k in LINEITEM_KEYS],
        F.xxhash64(*[F.col(c) for c in used]).alias("row_key"),
        category_value("l_returnflag", RETURNFLAG_CATEGORIES).alias("RF"),
        category_value("l_linestatus", LINESTATUS_CATEGORIES).alias("LS"),
        *[F.col(c) for c in LINEITEM_FEATURES])


# ---------------------------------------------------------------------------
# Season-like files cut from lineitem: one "file" per (ship year, returnflag),
# with a header that depends on the ship year, as match files of different
# seasons carry different columns.
# ---------------------------------------------------------------------------
LINEITEM_CATALOGUE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                      "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
                      "l_linestatus", "l_shipdate"]
HEADER_EARLY = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
                "ship_year"]
HEADER_MIDDLE = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                 "l_extendedprice", "l_returnflag", "l_linestatus"]
HEADER_LATE = ["l_orderkey", "l_linenumber", "l_tax", "l_linestatus", "net_price"]
EARLY_LAST_YEAR = 1996
MIDDLE_LAST_YEAR = 1998
PREFIX_LABELS = ["l_orderkey", "l_linenumber", "l_quantity"]


def ship_year() -> F.Column:
    return F.year("l_shipdate").cast("int")


def year_group_conditions(df: DataFrame | None = None) -> list[F.Column]:
    """Three conditions that split every row by ship year (null dates go
    last). Written as ranges of ``l_shipdate`` against literals of the
    column's own type, so Parquet gets them as pushed filters (row-group
    skipping) instead of a ``year()`` it cannot push."""
    t = df.schema["l_shipdate"].dataType if df is not None else None
    d = F.col("l_shipdate")

    def start_of(year: int):
        lit = F.lit(f"{year}-01-01 00:00:00")
        return lit.cast(t) if t is not None else lit.cast("timestamp_ntz")
    early = d < start_of(EARLY_LAST_YEAR + 1)
    middle = (d >= start_of(EARLY_LAST_YEAR + 1)) & (d < start_of(MIDDLE_LAST_YEAR + 1))
    late = d.isNull() | (d >= start_of(MIDDLE_LAST_YEAR + 1))
    return [early, middle, late]


def lineitem_with_derived(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    # ship_year is a double: after the union it is null for two of the three
    # groups, and a nullable double compares the same way everywhere
    return li.withColumn("ship_year", ship_year().cast("double")).withColumn(
        "net_price", F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")))


def lineitem_year_groups(spark: SparkSession, sf_dir: str) -> list[tuple[list[str], DataFrame]]:
    li = lineitem_with_derived(spark, sf_dir)
    headers = [HEADER_EARLY, HEADER_MIDDLE, HEADER_LATE]
    return [(h, li.where(cond).select(*h)) for h, cond in zip(headers, year_group_conditions(li))]


def season_code(year: F.Column) -> F.Column:
    """2000 -> '0001', 1999 -> '9900'."""
    return F.concat(F.lpad(F.pmod(year, F.lit(100)).cast("string"), 2, "0"),
                    F.lpad(F.pmod(year + F.lit(1), F.lit(100)).cast("string"), 2, "0"))


def lineitem_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header inventory ``file, season, start_year, header`` with one file per
    distinct (ship year, returnflag) of the whole lineitem table."""
    li = table(spark, sf_dir, "lineitem")
    files = li.select(ship_year().alias("start_year"), F.col("l_returnflag")).distinct()
    y = F.col("start_year")
    header = (F.when(y <= EARLY_LAST_YEAR, F.array(*[F.lit(t) for t in HEADER_EARLY]))
              .when(y <= MIDDLE_LAST_YEAR, F.array(*[F.lit(t) for t in HEADER_MIDDLE]))
              .otherwise(F.array(*[F.lit(t) for t in HEADER_LATE])))
    return files.select(
        F.concat(F.coalesce(y.cast("string"), F.lit("none")), F.lit("/"),
                 F.coalesce(F.col("l_returnflag"), F.lit("none")), F.lit(".csv")).alias("file"),
        season_code(y).alias("season"), y.alias("start_year"), header.alias("header"))


# ---------------------------------------------------------------------------
# Season CSV files written from lineitem (for the CSV source path)
# ---------------------------------------------------------------------------
CSV_EARLY = ["l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
             "l_discount", "l_returnflag", "l_shipdate"]
CSV_MIDDLE = ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
              "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate"]
CSV_LATE = ["l_orderkey", "l_linenumber", "l_tax", "l_linestatus", "l_returnflag", "net_price"]
CSV_EXCLUDES = ["l_partkey", "l_suppkey", "l_shipdate"]
CSV_TEMPLATE = "{root}/season={code}"


# Season of rows without a ship date, and in dirty files of those shipped later.
DIRTY_LAST_YEAR = 2001


def season_year() -> F.Column:
    return F.coalesce(ship_year(), F.lit(DIRTY_LAST_YEAR))


def season_years(spark: SparkSession, root: str) -> tuple[int, int]:
    """First and last season among the folders written below ``root`` (years of
    1970 to 2069)."""
    codes = [n.removeprefix("season=")[:2] for n in list_directories(spark, root) if n.startswith("season=")]
    years = [1900 + int(c) if int(c) >= 70 else 2000 + int(c) for c in codes if c.isdigit()]
    return min(years), max(years)


def write_lineitem_seasons(spark: SparkSession, sf_dir: str, root: str) -> str:
    """lineitem as season directories of CSV files with a header each; the
    header depends on the ship year (three layouts). One distributed write
    per layout, partitioned by season. Rows without a ship date have the late
    layout and the season of DIRTY_LAST_YEAR."""
    li = lineitem_with_derived(spark, sf_dir).withColumn("season", season_code(season_year()))
    for cols, cond in zip([CSV_EARLY, CSV_MIDDLE, CSV_LATE], year_group_conditions(li)):
        (li.where(cond).select(*cols, "season").write.mode("append")
         .partitionBy("season").option("header", True).csv(root))
    return root


#: Text files of a season of dirty files, their rows dealt by a hash of the line's key.
DIRTY_FILES = 4


def write_dirty_seasons(spark: SparkSession, sf_dir: str, root: str, files: int = DIRTY_FILES) -> str:
    """lineitem as season files such as hand-kept tables have them: ``files``
    text files per season, each with its header first. Every row has a quoted
    note with a comma; by line number modulo 4 a row is short (cut after the
    quantity), long (two cells more than titles), blank in the quantity, or
    whole. Seasons up to EARLY_LAST_YEAR lack the tax."""
    li = table(spark, sf_dir, "lineitem")
    year = F.least(season_year(), F.lit(DIRTY_LAST_YEAR))
    kind = F.col("l_linenumber") % 4

    def text(name: str) -> F.Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    early = year <= EARLY_LAST_YEAR
    head = [text("l_orderkey"), text("l_linenumber"),
            F.when(kind == 3, F.lit("")).otherwise(text("l_quantity"))]
    tail = [F.lit('"as given, see file"'), text("l_returnflag"), text("l_discount")]
    whole = F.when(early, F.concat_ws(",", *head, *tail, F.lit(","))).otherwise(
        F.concat_ws(",", *head, *tail, text("l_tax"), F.lit(",")))
    line = (F.when(kind == 1, F.concat_ws(",", *head))
            .when(kind == 2, F.concat(whole, F.lit(",x,y"))).otherwise(whole))
    part = F.pmod(F.xxhash64(*LINEITEM_KEYS), F.lit(files))
    rows = li.select(year.alias("year"), part.alias("part"), F.lit(1).alias("rank"), line.alias("value"))
    parts = rows.select("year", "part").distinct()
    title = F.when(F.col("year") <= EARLY_LAST_YEAR,
                   F.lit("l_orderkey,l_linenumber,l_quantity,note,l_returnflag,l_discount,,")).otherwise(
        F.lit("l_orderkey,l_linenumber,l_quantity,note,l_returnflag,l_discount,l_tax,,"))
    headers = parts.select("year", "part", F.lit(0).alias("rank"), title.alias("value"))
    # a file has its header once and first: a (season, part) is one sorted run of
    # rows, and partitions of their own keep runs from sharing a file
    for i in range(files):
        (headers.union(rows).where(F.col("part") == i).withColumn("season", season_code(F.col("year")))
         .repartition("season").sortWithinPartitions("season", "rank")
         .select("season", "value").write.mode("append").partitionBy("season").text(root))
    return root
