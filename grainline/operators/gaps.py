"""Pauses between purchases and returns after them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions import days_between, months_after
from grainline.functions._columns import Names, as_names
from grainline.operators.timeseries import along, with_previous


def purchase_gaps(fact: DataFrame, key: Names, date: str) -> DataFrame:
    """Days since the previous purchase day, one row per entity and day.

    Several purchases on one day count once, which bounds the rows of a key by
    the calendar before its window runs.
    """
    days = fact.select(*as_names(key), date).distinct()
    gaps = with_previous(days, key, date, date)
    previous = f"previous_{date}"
    return gaps.withColumn("inactive_days", days_between(previous, date))


def inactivity_gaps(fact: DataFrame, key: Names, date: str, min_days: int = 60) -> DataFrame:
    """Entities that paused for ``min_days`` or more and came back."""
    gaps = purchase_gaps(fact, key, date).filter(F.col("inactive_days") >= min_days)
    return gaps.groupBy(*as_names(key)).agg(
        F.max("inactive_days").alias("max_inactive_days"),
        F.count("*").alias("reactivation_count"),
    )


def month_reactivations(
    monthly: DataFrame, key: Names, period: str, months: int = 3, extra: bool = False
) -> DataFrame:
    """Active months and returns at least ``months`` months after the last one.

    ``extra`` adds the longest distance in days between two active months.
    """
    lagged = monthly.withColumn("_last_period", F.lag(period).over(along(key, period)))
    came_back = F.col(period) >= months_after("_last_period", months)
    measures = [
        F.count("*").alias("active_months"),
        F.count_if(F.coalesce(came_back, F.lit(False))).alias("reactivation_count"),
    ]
    if extra:
        measures.append(F.max(days_between("_last_period", period)).alias("max_month_gap_days"))
    return lagged.groupBy(*as_names(key)).agg(*measures)
