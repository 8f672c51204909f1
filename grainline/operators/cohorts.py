"""Cohorts by first active period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.functions import percent, total, units_between
from grainline.functions._columns import Names, as_names
from grainline.operators._joins import join_groups


def with_cohort(df: DataFrame, key: Names, period: str) -> DataFrame:
    """Add the first active period of the entity and the months since then."""
    first = F.min(period).over(W.partitionBy(*as_names(key)))
    return df.withColumn("cohort_month", first).withColumn(
        "months_since_first", units_between("cohort_month", period)
    )


def cohort_shares(
    entities: DataFrame,
    value: str = "lifetime_revenue",
    cohort: str = "cohort_month",
    total_out: str = "cohort_total_revenue",
    share_out: str = "cohort_revenue_percentage",
    members: DataFrame | None = None,
) -> DataFrame:
    """Share of each entity in the revenue of its cohort.

    The totals are a partial aggregate of ``members``, which are the entities
    themselves unless they are known from fewer columns or joins.
    """
    counted = entities if members is None else members
    totals = counted.groupBy(cohort).agg(total(value).alias(total_out))
    joined = join_groups(entities, totals, cohort)
    return joined.withColumn(share_out, percent(value, total_out))


def cohorts(monthly: DataFrame, key: Names, period: str, value: str) -> DataFrame:
    """One row per entity: cohort, months from first to latest, lifetime, share."""
    entities = monthly.groupBy(*as_names(key)).agg(
        F.min(period).alias("cohort_month"),
        F.max(period).alias("latest_month"),
        total(value).alias("lifetime_revenue"),
    )
    aged = entities.withColumn(
        "months_since_first", units_between("cohort_month", "latest_month")
    )
    return cohort_shares(aged)


def cohort_retention(monthly: DataFrame, key: Names, period: str) -> DataFrame:
    """Active entities per cohort and month since acquisition, with their share."""
    active = with_cohort(monthly, key, period)
    # At most one row per pair of months of the calendar.
    counts = active.groupBy("cohort_month", "months_since_first").agg(
        F.count("*").alias("active_entities")
    )
    size = F.max(F.when(F.col("months_since_first") == 0, F.col("active_entities")))
    with_size = counts.withColumn("cohort_size", size.over(W.partitionBy("cohort_month")))
    return with_size.withColumn("retention_pct", percent("active_entities", "cohort_size"))
