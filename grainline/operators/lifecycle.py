"""Churn, segments and conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions import days_between, percent
from grainline.functions._columns import Names, as_names


def churned(fact: DataFrame, key: Names, date: str, as_of: str, days: int) -> DataFrame:
    """Entities whose last activity before ``as_of`` is at least ``days`` old."""
    until = F.lit(as_of).cast("date")
    last = (
        fact.filter(F.col(date) < until)
        .groupBy(*as_names(key))
        .agg(F.max(date).alias("last_activity"))
    )
    idle = last.withColumn("idle_days", days_between("last_activity", until))
    return idle.filter(F.col("idle_days") >= days)


def with_segment(
    entities: DataFrame, value: str, bounds: dict[str, float], rest: str, out: str = "segment"
) -> DataFrame:
    """Name the first bound that the value reaches, highest first."""
    chosen = None
    for name, bound in sorted(bounds.items(), key=lambda item: -item[1]):
        reached = F.col(value) >= bound
        chosen = F.when(reached, name) if chosen is None else chosen.when(reached, name)
    segment = F.lit(rest) if chosen is None else chosen.otherwise(rest)
    return entities.withColumn(out, segment)


def conversion_rate(events: DataFrame, key: str, step: str, first: str, then: str) -> DataFrame:
    """How many entities with step ``first`` also have step ``then``."""
    seen = (
        events.filter(F.col(step).isin(first, then))
        .groupBy(key)
        .agg(
            F.max((F.col(step) == first).cast("int")).alias("_first"),
            F.max((F.col(step) == then).cast("int")).alias("_then"),
        )
    )
    started = F.sum("_first").alias("started")
    converted = F.sum(F.col("_first") * F.col("_then")).alias("converted")
    return seen.agg(started, converted).withColumn(
        "conversion_pct", percent("converted", "started")
    )
