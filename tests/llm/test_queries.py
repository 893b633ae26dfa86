"""Registered text queries against their SQL in another engine."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
import check
from roadstate.llm.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, db, name):
    got = QUERIES[name](spark, SF).toPandas()
    want = db.execute(ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.canonical(got) == check.canonical(want)
