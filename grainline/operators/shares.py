"""Shares of a group and comparisons with an average."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions import mean, percent, total
from grainline.functions._columns import Names, as_names
from grainline.operators._joins import join_groups


def group_totals(
    entities: DataFrame,
    group: Names,
    value: str,
    total_out: str = "group_total",
    average_out: str | None = None,
    count_out: str | None = None,
) -> DataFrame:
    """Attach the total, and if named the average and count, of each row's group.

    The totals come from a partial aggregate, so no task holds a whole group.
    """
    measures = [total(value).alias(total_out)]
    if average_out:
        measures.append(mean(value).alias(average_out))
    if count_out:
        measures.append(F.count(value).alias(count_out))
    totals = entities.groupBy(*as_names(group)).agg(*measures)
    return join_groups(entities, totals, group)


def share_of_group(
    entities: DataFrame,
    group: Names,
    value: str,
    out: str = "share_pct",
    total_out: str = "group_total",
    average_out: str | None = None,
    count_out: str | None = None,
) -> DataFrame:
    """Percentage of each row's value in the total of its group."""
    with_total = group_totals(entities, group, value, total_out, average_out, count_out)
    return with_total.withColumn(out, percent(value, total_out))


def above_average(df: DataFrame, value: str) -> DataFrame:
    """Rows above the average of all rows.

    Compared as ``value * count > sum``, which is exact for decimals.
    """
    overall = df.agg(F.struct(F.sum(value).alias("s"), F.count(value).alias("n"))).scalar()
    return df.filter(F.col(value) * overall["n"] > overall["s"])


def above_group_average(df: DataFrame, value: str, group: Names) -> DataFrame:
    """Rows above the average of their own group; rows without a group drop out."""
    groups = as_names(group)
    averages = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*groups)
        .agg(F.sum(value).alias("_sum"), F.count(value).alias("_n"))
    )
    above = df.join(averages, groups).filter(F.col(value) * F.col("_n") > F.col("_sum"))
    return above.select(*df.columns)


def percent_of_total(
    df: DataFrame, group: Names, count_out: str = "row_count", percent_out: str = "row_pct"
) -> DataFrame:
    """Rows per group and, unrounded, their percentage of all rows."""
    counts = df.groupBy(*as_names(group)).agg(F.count("*").alias(count_out))
    everything = counts.agg(F.sum(count_out)).scalar()
    return counts.withColumn(percent_out, F.col(count_out) * F.lit(100.0) / everything)
