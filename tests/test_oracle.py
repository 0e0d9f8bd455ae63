"""Every query that has SQL gives what DuckDB gives for it."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from loomwright.plans import catalogue


def text(x):
    return "" if x is None else f"{x:.4f}" if isinstance(x, float) else str(x)


@pytest.fixture(scope="module")
def oracle(sf):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_same_rows(spark, sf, oracle, name):
    got = entry.queries()[name](spark, sf)
    want = oracle.sql(entry.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = sorted(tuple(map(text, r)) for r in got.select(*columns).collect())
    assert rows == sorted(tuple(map(text, r)) for r in want.project(", ".join(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE)))
def test_rows_only(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
