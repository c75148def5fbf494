"""Every registered query against its SQL oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from helpers import SF_DIR

TABLES = ("benchmark", "documents", "pages")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(entry.text_search_queries()) == set(entry.text_search_oracles())


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["collection", "file", "score"]
    assert len(result.collect()) == 5


@pytest.mark.parametrize("name", sorted(entry.text_search_queries()))
def test_query_equals_oracle(spark, oracle, name):
    result = entry.queries()[name](spark, SF_DIR)
    expected = oracle.sql(entry.oracle_sql()[name])
    columns = sorted(result.columns)
    assert columns == sorted(expected.columns)
    picked = ", ".join(f'"{column}"' for column in columns)
    wanted = sorted(map(repr, expected.project(picked).fetchall()))
    found = sorted(repr(tuple(row)) for row in result.select(columns).collect())
    assert found == wanted
