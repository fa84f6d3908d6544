"""Every registered query against its DuckDB oracle, as the driver does it, at the small scale."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from cindergrid.plans.testbed_queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return connection


def normal(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in data))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, sf, duck, name):
    df = entry_point.queries()[name](spark, sf)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert normal(df.columns, df.collect()) == normal(columns, cursor.fetchall())


def test_entry(spark):
    df = entry_point.entry(spark)
    assert "trend_indicator" in df.columns and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(QUERIES) <= set(entry_point.oracle_sql())
