"""Period-over-period operators on frames with one row per entity and period.

Every window here runs inside one entity, whose rows are bounded by the
calendar because the fact was rolled up to periods first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.functions import MEAN, MONEY, TOTAL, growth_pct
from grainline.functions._columns import Names, as_names
from grainline.operators.ranking import top_k_per_group
from grainline.operators.rollup import rollup_years


def along(key: Names, period: str) -> WindowSpec:
    """Window over one entity in period order."""
    return W.partitionBy(*as_names(key)).orderBy(F.col(period).asc_nulls_last())


def with_previous(
    df: DataFrame, key: Names, period: str, columns: Names, prefix: str = "previous_"
) -> DataFrame:
    """Values of the previous *active* period; it need not be adjacent."""
    window = along(key, period)
    return df.withColumns({prefix + c: F.lag(c).over(window) for c in as_names(columns)})


def rolling(
    df: DataFrame,
    key: Names,
    period: str,
    value: str,
    n: int = 3,
    fn: str = "avg",
    digits: int | None = 2,
    out: str = "rolling",
) -> DataFrame:
    """Average or sum over the last ``n`` active rows of each entity."""
    frame = along(key, period).rowsBetween(-(n - 1), W.currentRow)
    if fn == "avg":
        column = F.avg(value).over(frame).cast(MEAN)
    elif fn == "sum":
        column = F.sum(value).over(frame).cast(TOTAL)
    else:
        raise ValueError(f"unknown function {fn!r}")
    if digits is not None:
        column = F.round(column, digits).cast(MONEY)
    return df.withColumn(out, column)


def running(df: DataFrame, key: Names, period: str, value: str, out: str = "running") -> DataFrame:
    """Running total along the periods of each entity."""
    return df.withColumn(out, F.sum(value).over(along(key, period)).cast(TOTAL))


def latest(df: DataFrame, key: Names, period: str) -> DataFrame:
    """The row of the latest period of each entity."""
    return top_k_per_group(df, key, period, 1).drop("rnk")


def best_period(df: DataFrame, key: Names, value: str, tie: Names) -> DataFrame:
    """The row with the highest value of each entity; the earliest ``tie`` wins."""
    return top_k_per_group(df, key, value, 1, tie=tie).drop("rnk")


def yoy(
    monthly: DataFrame,
    key: Names,
    period: str = "sales_month",
    value: str = "monthly_revenue",
) -> DataFrame:
    """Year sums with growth over the previous active year."""
    yearly = rollup_years(monthly, key, period, value)
    lagged = with_previous(yearly, key, "sales_year", "yearly_revenue").withColumnRenamed(
        "previous_yearly_revenue", "previous_year_revenue"
    )
    return lagged.withColumn("yoy_growth", growth_pct("yearly_revenue", "previous_year_revenue"))
