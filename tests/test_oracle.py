"""Every registered query equals its DuckDB oracle (sf0.001, non-UTC session)."""

import datetime as dt
import math
from collections import Counter

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from skytrace.plans.queries import QUERIES
from skytrace.session import TABLES


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    r = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(r.columns)
    assert _rows(df.columns, df.collect()) == _rows(r.columns, r.fetchall())


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "unique_aircraft" in df.columns
