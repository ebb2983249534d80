"""Every registered query against its DuckDB oracle on the smallest fixture (sf0.001)."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry
from paths import SF_SMALL
from salesmart.oracle_registry import oracle_sql
from salesmart.plans import catalog
from salesmart.sources.fixtures import TEST_TABLES

# the training-data queries have tests of their own
QUERIES = catalog.queries()
SQL = oracle_sql()


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, decimal.Decimal):
        return f"D{v}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    cols = df.columns
    srows = df.collect()
    rel = duck.sql(SQL[key])
    assert sorted(rel.columns) == sorted(cols)
    order = sorted(cols)
    got = sorted(tuple(canon(r[c]) for c in order) for r in srows)
    drows = rel.fetchall()
    idx = [rel.columns.index(c) for c in order]
    want = sorted(tuple(canon(r[i]) for i in idx) for r in drows)
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert "is_first_valid_deal" in df.columns
