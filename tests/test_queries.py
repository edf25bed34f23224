"""Every registered query against its SQL counterpart on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, rows
from swipeline.plans import queries as batch

SF = "/root/testdata/sf0.001"
QUERIES = batch.REGISTRY
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = QUERIES[name](spark, SF)
    got = rows(frame.columns, frame.collect())
    assert got
    if name in ORACLE:
        result = db.execute(ORACLE[name])
        columns = [c[0] for c in result.description]
        assert sorted(frame.columns) == sorted(columns)
        assert got == rows(columns, result.fetchall())


def test_no_oracle_without_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.count() == 1000 and "tx_count_10m" in frame.columns
