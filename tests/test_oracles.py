"""Every registered query against its SQL statement."""

import pytest
from compare import difference, duckdb_on

from __spark_entry__ import entry, oracle_sql, queries
from grainline.catalog import QUERIES
from oracles import STATEMENTS


@pytest.fixture(scope="module")
def database(folder):
    connection = duckdb_on(folder)
    yield connection
    connection.close()


def test_every_query_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)
    assert set(QUERIES) <= set(queries()) and set(STATEMENTS) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_statement(spark, folder, database, name):
    found, _ = difference(QUERIES[name](spark, folder), database, STATEMENTS[name])
    assert found == ""


def test_entry_returns_rows(spark, folder):
    assert entry(spark).count() > 0
