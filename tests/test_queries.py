"""Every registered query with SQL against DuckDB, the others against their shape."""

import math
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def cell(v):
    if v is None or isinstance(v, (bool, str)):
        return v
    v = float(v)
    return "nan" if math.isnan(v) else round(v, 6) + 0.0


@pytest.fixture(scope="module")
def db(sf):
    c = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        c.sql(f"create view {f.stem} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    cols = sorted(df.columns)
    got = Counter(tuple(cell(r[c]) for c in cols) for r in df.collect())
    rel = db.sql(ORACLES[name])
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    want = Counter(tuple(cell(r[i]) for i in at) for r in rel.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).columns == ["category", "reward", "rows", "coverage", "mean"]


def test_contract():
    assert set(ORACLES) <= set(QUERIES)
