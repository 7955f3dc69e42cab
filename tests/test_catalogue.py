"""Every catalogue query with SQL gives the rows of that SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from cuewise.plans import catalogue

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.10g}")
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    want = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.ORACLE_SQL)))
def test_rows_only(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def test_entry_point(spark):
    import __spark_entry__ as entry

    assert set(catalogue.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
