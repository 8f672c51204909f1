"""Money, averages, ratios and growth.

Money stays decimal from the scan to the result: a decimal sum does not
depend on the order in which tasks finish.  Ratios are taken in double,
brought to ten decimals and only then rounded half up.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from grainline.functions._columns import ColumnOrName, as_column
from grainline.functions.dates import adjacent

MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"
MEAN = "decimal(28,6)"
PERCENT = "decimal(18,2)"
_RATIO = "decimal(38,10)"


def exact(amount: ColumnOrName, kind: str) -> Column:
    """``amount`` as a decimal; one that does not fit is an error in every session."""
    given = as_column(amount)
    made = given.try_cast(kind)
    message = F.concat(F.lit(f"amount does not fit {kind}: "), given.cast("string"))
    return F.when(made.isNotNull() | given.isNull(), made).otherwise(
        F.raise_error(message).cast(kind)
    )


def money(amount: ColumnOrName) -> Column:
    return exact(amount, MONEY)


def total(amount: ColumnOrName) -> Column:
    """Aggregate: exact sum of a money column over any number of rows.

    The amounts are widened before they are summed; Spark gives a sum ten
    digits more than its input has.
    """
    return F.sum(as_column(amount).cast(TOTAL)).cast(TOTAL)


def mean(amount: ColumnOrName) -> Column:
    """Aggregate: average of a money column, six decimals."""
    return F.avg(as_column(amount)).cast(MEAN)


def percent(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``part`` as a percentage of ``whole``, two decimals; NULL when whole is 0."""
    part = as_column(part).cast("double")
    whole = F.nullif(as_column(whole).cast("double"), F.lit(0.0))
    return F.round((part * 100 / whole).cast(_RATIO), 2).cast(PERCENT)


def growth_pct(current: ColumnOrName, previous: ColumnOrName) -> Column:
    """Change from ``previous`` to ``current`` in percent; NULL without a base."""
    current, previous = as_column(current), as_column(previous)
    return percent(current - previous, previous)


def growth_flag(
    current: ColumnOrName,
    previous: ColumnOrName,
    period: ColumnOrName,
    previous_period: ColumnOrName,
    unit: str = "month",
) -> Column:
    """1 where the value rose against the directly preceding period, else 0."""
    rose = as_column(current) > as_column(previous)
    return F.when(adjacent(previous_period, period, unit) & rose, 1).otherwise(0)


def or_zero(amount: ColumnOrName) -> Column:
    return F.coalesce(as_column(amount), F.lit(0))


def annual_salary(monthly: ColumnOrName) -> Column:
    """Twelve monthly salaries."""
    return (as_column(monthly).cast("decimal(10,2)") * 12).cast("decimal(12,2)")
