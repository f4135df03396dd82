"""Registered queries of the subpackage against DuckDB, written from the contracts."""

import os

import duckdb
import pytest

from roadlake.llm.oracle import ORACLE
from roadlake.llm.queries import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = duck.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    got = sorted((tuple(row) for row in df.select(*names).collect()), key=repr)
    assert got == sorted(cursor.fetchall(), key=repr)


def test_names_and_numbers():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, len(QUERIES) + 1))
    assert set(ORACLE) < set(QUERIES)
