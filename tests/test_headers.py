"""The first-lines source and the stored inventory."""

import gzip
import warnings

import pytest
from pyspark.sql import functions as F

from tablefit.operators.align import distinct_headers, header_coverage, merged_titles, merged_titles_from_headers
from tablefit.plans.tables import (CSV_TEMPLATE, DIRTY_LAST_YEAR, RETURNFLAG_CATEGORIES, season_years, write_dirty_seasons,
                                   write_lineitem_seasons)
from tablefit.session import list_files, scratch_dir
from tablefit.sources import csv_tables, headers
from tablefit.sources.csv_tables import collate, first_lines, header_inventory, stored_inventory
from tablefit.sources.seasons import seasons


def test_first_line_of_odd_files(tmp_path):
    cases = {
        "plain.csv": (b"A,B\n1,2\n", "A,B"), "crlf.csv": (b"A,B\r\n1,2", "A,B"), "cr.csv": (b"A,B\r1,2", "A,B"), "one.csv": (b"A,B", "A,B"),
        "empty.csv": (b"", None), "blank.csv": (b"\n \t\r\n", None), "late.csv": (b"\n\n A,B\n", " A,B"),
        "bom.csv": (b"\xef\xbb\xbfA,B\n", "﻿A,B"), "long.csv": (b"x" * 300_000 + b",y\n1", "x" * 300_000 + ",y"),
        "odd [1] %20+.csv": (b"Q\n", "Q"), "bad.csv": (b"A\xff,B\n", "A�,B"),
    }
    for name, (content, line) in cases.items():
        (tmp_path / name).write_bytes(content)
        assert headers.first_line(str(tmp_path / name)) == line, name
        assert headers.first_line(f"file:{tmp_path}/{name}") == line, name
    (tmp_path / "z.csv.gz").write_bytes(gzip.compress(b"G,H\n1,2\n"))
    assert headers.first_line(str(tmp_path / "z.csv.gz")) == "G,H"


def test_source_lists_what_spark_would(spark, tmp_path):
    for i in range(25):
        (tmp_path / f"f{i}.csv").write_text(f"T{i},x\n{i},1\n")
    for hidden in ("_tmp.csv", ".f.csv.crc", "notes.txt"):
        (tmp_path / hidden).write_text("no\n")
    (tmp_path / "sub.csv").mkdir()
    spark.dataSource.register(headers.FirstLines)
    df = spark.read.format("first_lines").option("directories", f'["{tmp_path}", "{tmp_path}/none"]') \
        .option("glob", "*.csv").option("filesPerPartition", "10").load()
    assert df.rdd.getNumPartitions() == 3
    rows = {r.file.rsplit("/", 1)[1]: r.line for r in df.collect()}
    assert rows == {f"f{i}.csv": f"T{i},x" for i in range(25)}
    assert spark.read.format("first_lines").load().count() == 0


def test_both_ways_find_the_same_lines(spark, tmp_path, monkeypatch):
    for i in range(6):
        (tmp_path / f"f{i}.csv").write_text(f"A,B{i},\n" + "1,2\n" * 2000)
    by_source = {r.file.rsplit("/", 1)[1]: r.line for r in first_lines(spark, [str(tmp_path)]).collect()}
    monkeypatch.setattr(csv_tables, "can_open", lambda path: False)
    by_scan = {r.file.rsplit("/", 1)[1]: r.line for r in first_lines(spark, [str(tmp_path)]).collect()}
    assert by_source == by_scan and len(by_scan) == 6
    assert not headers.can_open("viewfs://store/in")


def test_every_listed_file_must_have_its_row(spark, tmp_path, monkeypatch):
    (tmp_path / "0001").mkdir()
    for name in ("a.csv", "b.csv"):
        (tmp_path / "0001" / name).write_text("FTHG,FTAG\n1,2\n")
    (tmp_path / "0001" / "empty.csv").write_text("")
    ss = seasons(str(tmp_path), 2000, 2001)
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert stored_inventory(spark, ss).count() == 2
    assert any("without any line" in str(x.message) for x in w)
    assert collate(spark, str(tmp_path), 2000, 2001).table.count() == 2
    real = header_inventory
    monkeypatch.setattr(csv_tables, "header_inventory", lambda *a: real(*a).where(~F.col("file").endswith("b.csv")))
    with pytest.raises(RuntimeError, match="3 files are listed, 2 headers"):
        stored_inventory(spark, ss)


def test_text_is_read_once(spark, tmp_path):
    root = write_lineitem_seasons(spark, "/root/testdata/sf0.001", scratch_dir(spark, "once"))
    first, last = season_years(spark, root)
    inv = header_inventory(spark, seasons(root, first, last + 1, CSV_TEMPLATE))
    plan = inv._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "Exchange" not in plan
    table = collate(spark, root, first, last + 1, [], RETURNFLAG_CATEGORIES, CSV_TEMPLATE, key_col=None).table
    assert table._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 3


def test_titles_by_distinct_header(spark):
    rows = [("b", "0001", 2000, ["A", "B"]), ("a", "0001", 2000, ["B", "C", "C"]), ("c", "0102", 2001, ["B", "C", "C"]),
            ("d", "0102", 2001, ["D", "A", "E"]), ("e", "0203", 2002, [])]
    inv = spark.createDataFrame(rows, "file string, season string, start_year int, header array<string>")
    assert distinct_headers(inv).count() == 4
    in_order = sorted(rows, key=lambda r: (r[2], r[0]))
    assert merged_titles(inv) == merged_titles_from_headers([r[3] for r in in_order]) == ["B", "C", "A", "D", "E"]
    assert {r.title: r.n_files for r in header_coverage(inv).collect()} == {"A": 2, "B": 3, "C": 2, "D": 1, "E": 1}


def test_a_season_of_dirty_files_has_several(spark):
    root = write_dirty_seasons(spark, "/root/testdata/sf0.001", scratch_dir(spark, "dirty"), files=3)
    first, last = season_years(spark, root)
    assert last == DIRTY_LAST_YEAR
    names = list_files(spark, f"{root}/season=9798")
    assert sum(n.endswith(".txt") for n in names) == 3
    col = collate(spark, root, first, last + 1, ["note"], RETURNFLAG_CATEGORIES, CSV_TEMPLATE, key_col=None, glob="*.txt")
    assert col.table.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert col.table.where("l_orderkey IS NULL").count() == 0  # no header among the rows
