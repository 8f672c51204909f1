"""Calendar arithmetic on DATE columns.

Month starts are dates, never timestamps, so no session time zone can move
them into a neighbouring month.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainline.functions._columns import ColumnOrName, as_column


def period_start(date: ColumnOrName, grain: str) -> Column:
    """First day of the ``day``, ``month``, ``quarter`` or ``year`` of a date."""
    if grain == "day":
        return as_column(date).cast("date")
    if grain not in ("month", "quarter", "year"):
        raise ValueError(f"unknown grain {grain!r}")
    return F.trunc(as_column(date), grain)


def month_start(date: ColumnOrName) -> Column:
    return period_start(date, "month")


def year_of(date: ColumnOrName) -> Column:
    return F.year(as_column(date))


def quarter_of(date: ColumnOrName) -> Column:
    return F.quarter(as_column(date))


def next_day(date: ColumnOrName) -> Column:
    return F.date_add(as_column(date), 1)


def months_before(date: ColumnOrName, months: int = 1) -> Column:
    return F.add_months(as_column(date), -months)


def months_after(date: ColumnOrName, months: int) -> Column:
    return F.add_months(as_column(date), months)


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole days from ``start`` to ``end``."""
    return F.datediff(as_column(end), as_column(start))


def units_between(start: ColumnOrName, end: ColumnOrName, unit: str = "month") -> Column:
    """Whole units from ``start`` to ``end``; for months both are month starts."""
    start, end = as_column(start), as_column(end)
    if unit == "day":
        return F.datediff(end, start)
    if unit == "month":
        return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    raise ValueError(f"unknown unit {unit!r}")


def adjacent(previous: ColumnOrName, current: ColumnOrName, unit: str = "month") -> Column:
    """True where ``previous`` is the calendar period right before ``current``."""
    previous, current = as_column(previous), as_column(current)
    if unit == "day":
        return previous == F.date_sub(current, 1)
    if unit == "month":
        return previous == F.add_months(current, -1)
    raise ValueError(f"unknown unit {unit!r}")


def in_range(date: ColumnOrName, start: str, end: str) -> Column:
    """Half-open date range ``[start, end)``; reaches the file scan as a filter."""
    date = as_column(date)
    return (date >= F.lit(start).cast("date")) & (date < F.lit(end).cast("date"))


def in_year(date: ColumnOrName, year: int) -> Column:
    """Calendar-year test written as a range, so that scans can skip files."""
    return in_range(date, f"{year:04d}-01-01", f"{year + 1:04d}-01-01")
