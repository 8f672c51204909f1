from __future__ import annotations

import os
import sys
from datetime import date
from decimal import Decimal

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from grainline.session import tuned_builder  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = tuned_builder(
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    ).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    if not os.path.isdir(DATA):
        pytest.skip(f"no test tables at {DATA}")
    return DATA


def _value(text, kind):
    if text is None or not isinstance(text, (str, int)):
        return text
    if kind == "date":
        return date.fromisoformat(text if len(text) == 10 else f"{text}-01")
    if kind.startswith("decimal"):
        return Decimal(str(text))
    return text


@pytest.fixture
def frame(spark):
    """Build a frame from a schema string and rows with plain values.

    Dates are written "2024-01-31", or "2024-01" for a month start.
    """

    def build(schema: str, *rows):
        fields = [f.strip().split(" ", 1) for f in schema.split(";")]
        ddl = ", ".join(f"{n} {k}" for n, k in fields)
        data = [tuple(_value(v, k) for v, (_, k) in zip(row, fields)) for row in rows]
        return spark.createDataFrame(data, ddl)

    return build


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples of plain values."""

    def plain(value):
        if isinstance(value, Decimal):
            return float(value)
        if isinstance(value, date):
            return value.isoformat()
        return value

    def read(df, *columns):
        picked = df.select(*columns) if columns else df
        found = [tuple(plain(v) for v in row) for row in picked.collect()]
        return sorted(found, key=lambda r: tuple((v is None, v) for v in r))

    return read
