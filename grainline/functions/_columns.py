"""Small helpers for arguments that are a column or its name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str
Names = str | Iterable[str]


def as_column(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_names(value: Names | None) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)
