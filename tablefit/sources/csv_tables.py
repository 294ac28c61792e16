"""Match files whose headers differ (S2-S6) and their collation.

1. Directory scan (S2): the season directories that exist; inside them only
   files ending in ``.csv`` (``pathGlobFilter``).
2. Header inventory (S3, S4): the first line of every file, by the
   ``first_lines`` source: its partitions are groups of files, and a task reads
   only the start of each. The header's trailing commas are dropped; inner
   blank titles are dropped. The inventory is stored, and has to hold every
   file that the directories list. (On a store that only Spark can read the
   lines come from two scans of the text, by file offset and line position.)
3. Grouped scan: files are grouped by their header, and each distinct
   header is read with ONE ``spark.read.csv`` over all its files, with an
   explicit all-string schema (positional names ``_c0.._cN``). PERMISSIVE
   mode pads short rows with nulls and cuts long ones (S6); quoted cells
   keep their commas (S5); blank lines yield no row. So the plan has one
   scan per distinct header, never one per file.
4. Each group is cleaned (exclusions, typed cells, last duplicate title
   wins) and all groups are stacked by name in the merged column order.

Only the distinct headers with their file names reach the driver. File names
may hold any character: Spark reports paths URL-encoded and takes paths as
glob patterns, so they are decoded and escaped before files are read.
"""

from __future__ import annotations

import json
import re
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablefit.functions.cells import typed_cell
from tablefit.functions.fixed import RESULT_CATEGORIES
from tablefit.operators.align import merged_titles, union_by_name
from tablefit.session import list_files, path_exists, scratch_dir
from tablefit.sources.headers import FirstLines, can_open, wanted
from tablefit.sources.seasons import DEFAULT_TEMPLATE, Season, seasons

INVENTORY_SCHEMA = T.StructType([
    T.StructField("file", T.StringType(), False),
    T.StructField("season", T.StringType(), True),
    T.StructField("start_year", T.IntegerType(), True),
    T.StructField("raw_header", T.ArrayType(T.StringType()), True),
    T.StructField("header", T.ArrayType(T.StringType()), True),
])


def existing_seasons(spark: SparkSession, season_list: Sequence[Season]) -> tuple[list[Season], list[Season]]:
    """Split seasons into (present, missing) directories."""
    present, missing = [], []
    for s in season_list:
        (present if path_exists(spark, s.path) else missing).append(s)
    for s in missing:
        warnings.warn(f"season directory {s.path!r} does not exist; skipped")
    return present, missing


def plain_path(path_col: Column) -> Column:
    """The path behind a URL-encoded one (a plus sign stands for itself)."""
    return F.url_decode(F.replace(path_col, F.lit("+"), F.lit("%2B")))


def glob_escaped(path: str) -> str:
    """``path`` as a pattern that matches only itself."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def _dir_name(path_col: Column) -> Column:
    """Name of the directory that holds a file."""
    return F.element_at(F.split(path_col, "/"), -2)


def _season_columns(path_col: Column, season_list: Sequence[Season]) -> tuple[Column, Column]:
    """(season code, start_year) of a file from its directory name; the
    season directories are known, so this is a CASE over at most the
    number of seasons."""
    dname = _dir_name(path_col)
    code, year = None, None
    for s in season_list:
        leaf = s.path.rstrip("/").split("/")[-1]
        cond = dname == F.lit(leaf)
        code = F.when(cond, F.lit(s.code)) if code is None else code.when(cond, F.lit(s.code))
        year = (F.when(cond, F.lit(s.start_year)) if year is None
                else year.when(cond, F.lit(s.start_year)))
    if code is None:
        return F.lit(None).cast("string"), F.lit(None).cast("int")
    return code, year.cast("int")


def split_header(line: Column) -> Column:
    """The header's fields as written (line end dropped). Trailing commas
    give blank titles: they stay positions of the read schema, so rows that
    end in the same commas have the header's width, and vanish from the
    cleaned header (S4)."""
    # a UTF-8 byte-order mark before the first title is not part of it
    clean = F.regexp_replace(F.regexp_replace(line, "^\ufeff", ""), r"[\r\n]+$", "")
    return F.split(clean, ",")


def clean_header(raw: Column, excludes: Sequence[str]) -> Column:
    """Titles kept after exclusions, blank titles dropped, in file order."""
    drop = F.array(*[F.lit(x) for x in excludes]) if excludes else F.array().cast("array<string>")
    return F.filter(raw, lambda t: (F.trim(t) != F.lit("")) & ~F.array_contains(drop, t))


def _first_lines_by_scan(spark: SparkSession, directories: Sequence[str], glob: str) -> DataFrame:
    """``file, line`` by two scans of the whole text, for stores that only
    Spark's readers open. The first split of a file starts at offset 0, and
    inside a split the sequence id grows with the line order, so the first line
    is the block-0 line with the smallest id."""
    lines = (spark.read.option("pathGlobFilter", glob)
             .text([glob_escaped(d) for d in directories])
             .select("value", plain_path(F.col("_metadata.file_path")).alias("file"),
                     F.col("_metadata.file_block_start").alias("_off"),
                     F.monotonically_increasing_id().alias("_seq")))
    block0 = lines.where((F.col("_off") == 0) & (F.trim("value") != ""))
    firsts = block0.groupBy("file").agg(F.min("_seq").alias("_seq"))
    return block0.join(firsts, ["file", "_seq"], "inner").select("file", F.col("value").alias("line"))


def first_lines(spark: SparkSession, directories: Sequence[str], glob: str = "*.csv") -> DataFrame:
    """``file, line`` for every file of the directories."""
    if not all(can_open(d) for d in directories):
        return _first_lines_by_scan(spark, directories, glob)
    spark.dataSource.register(FirstLines)
    return (spark.read.format("first_lines").option("directories", json.dumps(list(directories)))
            .option("glob", glob).load())


def header_inventory(spark: SparkSession, season_list: Sequence[Season],
                     excludes: Sequence[str] = (), glob: str = "*.csv") -> DataFrame:
    """S3: ``file, season, start_year, raw_header, header`` per file; a file
    without any line has empty headers."""
    if not season_list:
        return spark.createDataFrame([], INVENTORY_SCHEMA)
    first = first_lines(spark, [s.path for s in season_list], glob)
    code, year = _season_columns(F.col("file"), season_list)
    none = F.array().cast("array<string>")
    raw = F.coalesce(split_header(F.col("line")), none)
    return first.select("file", code.alias("season"), year.alias("start_year"),
                        raw.alias("raw_header"), clean_header(raw, excludes).alias("header"))


def stored_inventory(spark: SparkSession, season_list: Sequence[Season],
                     excludes: Sequence[str] = (), glob: str = "*.csv") -> DataFrame:
    """The inventory as a stored table, checked against the directories' own
    lists: every listed file has its row."""
    path = scratch_dir(spark, "inventory")
    header_inventory(spark, season_list, excludes, glob).write.parquet(path)
    inv = spark.read.schema(INVENTORY_SCHEMA).parquet(path)
    found = inv.count()
    names = [n for s in season_list for n in list_files(spark, s.path) if wanted(n, glob)]
    readable = all(can_open(s.path) for s in season_list)
    if found > len(names) or readable and found < len(names):
        raise RuntimeError(f"{len(names)} files are listed, {found} headers were read")
    if found < len(names) or not inv.where(F.size("raw_header") == 0).isEmpty():
        warnings.warn("files without any line have no header and no rows")
    return inv.where(F.size("raw_header") > 0)


@dataclass
class Collated:
    table: DataFrame                     # merged, typed rows
    inventory: DataFrame                 # one row per file
    titles: list[str]                    # merged column order (U2)
    missing: list[Season] = field(default_factory=list)
    unknown: list[str] = field(default_factory=list)
    repairs: Observation | None = None   # counts by season, with ``report``
    years: list[int] = field(default_factory=list)

    def repair_report(self) -> DataFrame:
        """``start_year, n_rows, n_short, n_long, n_blank`` per season: rows, rows
        with fewer and with more cells than titles, and rows without any kept
        cell. Needs ``collate(..., report=True)`` and an action on the table;
        the counts come from that action's own parse."""
        if self.repairs is None:
            raise ValueError("collate with report=True to count repairs")
        got = self.repairs.get
        rows = [(y, *(int(got[f"{c}_{y}"]) for c in _REPAIRS)) for y in self.years]
        schema = "start_year int, " + ", ".join(f"n_{c} long" for c in _REPAIRS)
        return self.table.sparkSession.createDataFrame(rows, schema)


AUDIT_COL = "width_repaired"
_REPAIRS = ["rows", "short", "long", "blank"]
_CELLS = "_cells_off"


def cells_in(line: Column) -> Column:
    """Cells of a CSV line: its commas outside quotes, and one."""
    return F.size(F.split(F.regexp_replace(line, '"[^"]*"', ""), ","))


def _observed(table: DataFrame, titles: Sequence[str], years: Sequence[int]) -> tuple[DataFrame, Observation]:
    blank = reduce(lambda a, b: a & b, [F.col(f"`{t}`").isNull() for t in titles], F.lit(True))
    off = F.col(_CELLS)
    says = {"rows": F.lit(True), "short": off < 0, "long": off > 0, "blank": blank}
    counts = [F.count_if((F.col("start_year") == y) & cond).alias(f"{c}_{y}") for y in years for c, cond in says.items()]
    seen = Observation()
    return table.observe(seen, *counts).drop(_CELLS), seen


def _group_frame(spark: SparkSession, files: Sequence[str], raw_header: Sequence[str],
                 kept: Sequence[str], season_list: Sequence[Season],
                 categories: Mapping[str, float], key_col: str | None,
                 audit: bool = False) -> DataFrame:
    fields = [T.StructField(f"_c{i}", T.StringType(), True) for i in range(len(raw_header))]
    if audit:
        fields.append(T.StructField("_corrupt_record", T.StringType(), True))
    reader = (spark.read.schema(T.StructType(fields)).option("header", True)
              .option("mode", "PERMISSIVE").option("quote", '"'))
    if audit:
        # a wrong row width only shows when every column is tokenised
        reader = (reader.option("columnNameOfCorruptRecord", "_corrupt_record")
                  .option("columnPruning", False))
    df = reader.csv([glob_escaped(f) for f in files])
    # last duplicate title wins (its cell is the one kept)
    last_pos = {t: i for i, t in enumerate(raw_header)}
    path = plain_path(F.col("_metadata.file_path"))
    code, year = _season_columns(path, season_list)
    cols = [typed_cell(F.col(f"_c{last_pos[t]}"), categories).alias(t) for t in kept]
    extra = [code.alias("season"), year.alias("start_year")]
    if audit:
        # short rows were padded and long rows cut; flagged, never dropped
        bad = F.col("_corrupt_record")
        extra.append(bad.isNotNull().alias(AUDIT_COL))
        extra.append(F.coalesce(cells_in(bad) - F.lit(len(raw_header)), F.lit(0)).alias(_CELLS))
    if key_col:
        # a row key that depends only on the season, the file's name and the
        # row's cells, so a split on it repeats whatever the partitioning and
        # wherever the files lie
        extra.append(F.xxhash64(_dir_name(path), F.element_at(F.split(path, "/"), -1),
                                *[F.col(f"_c{i}") for i in range(len(raw_header))]).alias(key_col))
    return df.select(*cols, *extra)


def collate(spark: SparkSession, root: str, start_year: int, end_year: int,
            excludes: Sequence[str] = (), categories: Mapping[str, float] = RESULT_CATEGORIES,
            template: str = DEFAULT_TEMPLATE, key_col: str | None = "match_key",
            catalogue: Sequence[str] | None = None, glob: str = "*.csv",
            audit: bool = False, min_year: int | None = None,
            max_year: int | None = None, report: bool = False) -> Collated:
    """S1-S6 + P1-P3 + U1-U4: season files under ``root`` -> one typed table
    with the merged column order, plus ``season``/``start_year`` (and a row
    key) columns. With ``audit``, a ``width_repaired`` flag marks rows whose
    cell count differed from their header (S6); such reads parse every
    column. ``report`` counts repaired and blank rows by season while the table
    is read (``Collated.repair_report``). ``min_year`` and ``max_year`` refuse
    seasons beyond them."""
    wanted = seasons(root, start_year, end_year, template, min_year, max_year)
    present, missing = existing_seasons(spark, wanted)
    inv = stored_inventory(spark, present, excludes, glob) if present else header_inventory(spark, present)
    # a row per distinct header, with the names of its files
    groups = (inv.groupBy("raw_header").agg(
        F.any_value("header").alias("header"), F.sort_array(F.collect_list("file")).alias("files"),
        F.min(F.struct("start_year", "file")).alias("first")).orderBy("first").collect())
    if not groups:
        raise ValueError(f"no match files for seasons [{start_year}, {end_year}) under {root}")
    titles = merged_titles(inv)
    frames = [_group_frame(spark, g["files"], list(g["raw_header"]), list(dict.fromkeys(g["header"])), present,
                           categories, key_col, audit or report)
              for g in groups]
    table, seen = union_by_name(frames, titles), None
    years = [s.start_year for s in present]
    if report:
        table, seen = _observed(table, titles, years)
    table = table.drop(_CELLS) if audit else table.drop(_CELLS, AUDIT_COL)
    unknown = []
    if catalogue is not None:
        known = set(catalogue)
        unknown = [t for t in titles if t not in known]
        if unknown:
            warnings.warn(f"columns not in the catalogue: {unknown}")
    return Collated(table, inv, titles, missing, unknown, seen, years)
