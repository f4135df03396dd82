"""Every registered query against DuckDB on the same files."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry
from roadlake.plans.oracle import ORACLE
from roadlake.plans.registry import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{SF_DIR}/events.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    for row in rows:
        assert not any(isinstance(v, float) and math.isnan(v) for v in row)
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = [tuple(row) for row in df.collect()]
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert len(got) == len(want) > 0
    assert comparable(df.columns, got) == comparable(names, want)


def test_entry(spark):
    assert entry(spark).count() == 40
