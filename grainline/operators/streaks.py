"""Unbroken runs of periods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.functions import adjacent, units_between
from grainline.functions._columns import Names, as_names
from grainline.operators.timeseries import along


def with_run_length(
    df: DataFrame,
    key: Names,
    period: str,
    value: str | None = None,
    mode: str = "growth",
    unit: str = "month",
    out: str = "run_length",
    start: str = "run_start",
) -> DataFrame:
    """Add to each row the start of its run and the length of the run so far.

    ``mode="growth"`` counts increases: four rising months have length 3.
    ``mode="activity"`` counts periods: four months in a row have length 4.
    The frame has one row per key and period.  Periods inside a run follow one
    another without a gap, so its length is a calendar difference and needs no
    grouping by run.
    """
    if mode not in ("growth", "activity"):
        raise ValueError(f"unknown mode {mode!r}")
    window = along(key, period)
    goes_on = adjacent("_last_period", period, unit)
    lags = {"_last_period": F.lag(period).over(window)}
    if mode == "growth":
        if value is None:
            raise ValueError("growth runs need a value column")
        lags["_last_value"] = F.lag(value).over(window)
        goes_on = goes_on & (F.col(value) > F.col("_last_value"))
    begins = F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(F.col(period))
    so_far = window.rowsBetween(W.unboundedPreceding, W.currentRow)
    length = units_between(start, period, unit) + (1 if mode == "activity" else 0)
    return (
        df.withColumns(lags)
        .withColumn(start, F.max(begins).over(so_far))
        .withColumn(out, length.cast("bigint"))
        .drop(*lags)
    )


def streaks(
    df: DataFrame,
    key: Names,
    period: str,
    value: str | None = None,
    mode: str = "growth",
    unit: str = "month",
) -> DataFrame:
    """One row per run: key, first and last period, length."""
    rows = with_run_length(df, key, period, value, mode, unit)
    return (
        rows.groupBy(*as_names(key), "run_start")
        .agg(F.max(period).alias("run_end"), F.max("run_length").alias("streak_length"))
        .filter(F.col("streak_length") >= 1)
    )


def longest_streak(
    df: DataFrame,
    key: Names,
    period: str,
    value: str | None = None,
    mode: str = "growth",
    unit: str = "month",
    out: str = "longest_streak",
) -> DataFrame:
    """Longest run per entity; an entity that never grew has no row."""
    rows = with_run_length(df, key, period, value, mode, unit)
    longest = rows.groupBy(*as_names(key)).agg(F.max("run_length").alias(out))
    return longest.filter(F.col(out) >= 1)
