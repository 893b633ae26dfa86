"""Registered queries against their SQL in another engine."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
import check
from roadstate.plans import registry

# Covered by the stream, source and model tests; the full comparison is check.py.
SLOW = {name for name in registry.QUERIES if name.startswith("stream_")} | {
    "kmeans_states", "kmeans_planted", "kmeans_metrics", "pipeline_once", "lake_tables", "ingest_ledger", "model_by_alias", "ingest_topic", "merge_insert_only", "replace_by_key", "drain_predictions",
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in check.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_every_query_has_sql_but_the_fit():
    assert set(registry.QUERIES) - set(entry.oracle_sql()) == {"kmeans_states"}
    assert set(registry.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - SLOW))
def test_query_equals_sql(spark, db, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = db.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.canonical(got) == check.canonical(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
