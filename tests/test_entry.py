"""The driver contract at sf0.001: every key runs and equals its DuckDB oracle."""

import datetime as dt
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from postlake.plans.registry import QUERIES

TABLES = ["nation", "customer", "orders", "documents"]


def norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["country", "category", "n"]
    assert df.count() == 25


def test_every_key_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_key_matches_oracle(spark, sf_small, duck, key):
    df = E.queries()[key](spark, sf_small)
    res = duck.execute(E.oracle_sql()[key])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert bag(df.columns, df.collect()) == bag(names, res.fetchall())
