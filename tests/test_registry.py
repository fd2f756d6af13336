"""Every registered query runs, and equals its DuckDB twin on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import TABLES, rows_of

SMALL = "/root/testdata/sf0.001"
TWINS = oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


def test_every_twin_has_a_query():
    assert set(TWINS) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_its_twin(spark, duck, name):
    got = queries()[name](spark, SMALL)
    want = duck.sql(TWINS[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of([tuple(r) for r in got.collect()], got.columns) == rows_of(want.fetchall(), want.columns)
