"""Run a registered query on Spark and its statement on DuckDB, and compare."""

from __future__ import annotations

import os
from collections import Counter

import duckdb

_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def duckdb_on(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{file}'")
    return connection


def _expected_type(spark_type: str) -> str:
    return _TYPES.get(spark_type, spark_type.upper())


def difference(df, connection: duckdb.DuckDBPyConnection, statement: str) -> tuple[str, int]:
    """A description of the first difference ("" if none) and the row count."""
    result = connection.execute(statement)
    oracle_columns = [c[0] for c in result.description]
    expected_rows = result.fetchall()
    described = connection.execute(f"DESCRIBE {statement}").fetchall()
    oracle_types = {name: kind for name, kind, *_ in described}
    spark_types = {name: _expected_type(kind).replace(" ", "") for name, kind in df.dtypes}
    if sorted(spark_types) != sorted(oracle_columns):
        return f"columns {sorted(spark_types)} != {sorted(oracle_columns)}", len(expected_rows)
    if spark_types != oracle_types:
        odd = {c: (t, oracle_types[c]) for c, t in spark_types.items() if t != oracle_types[c]}
        return f"types {odd}", len(expected_rows)
    order = sorted(oracle_columns)
    found = Counter(tuple(row[c] for c in order) for row in df.collect())
    places = [oracle_columns.index(c) for c in order]
    expected = Counter(tuple(row[i] for i in places) for row in expected_rows)
    if found != expected:
        return (
            f"{sum(found.values())} rows, expected {len(expected_rows)}; "
            f"only in Spark {list((found - expected).items())[:2]}; "
            f"only in SQL {list((expected - found).items())[:2]}",
            len(expected_rows),
        )
    return "", len(expected_rows)
