"""Every registered query with an oracle agrees with DuckDB (sf0.001)."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF001

SLOW = {"parameter_sweep", "regression_sweep"}


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "null"
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def _digest(pdf):
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(v) for v in r) for r in pdf[cols].itertuples(index=False))
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF001):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF001}/{f}')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = entry.queries()[name](spark, SF001).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert _digest(got) == _digest(want)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_query_without_oracle_runs(spark, name):
    df = entry.queries()[name](spark, SF001)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and rows[0]["trainer"] == "naive_bayes"
