"""Chains of any length in a parent table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions import TOTAL, total
from grainline.session import discard, session_path, written


def hierarchy_levels(df: DataFrame, key: str, parent: str) -> DataFrame:
    """The top of each row's chain of parents and its distance from there.

    Every round doubles the distance that a row has climbed, so a chain of a
    thousand parents takes ten joins.  Rows that have reached a top leave the
    join; they would all meet at the keys of the few tops.  A parent that is
    not in the table counts as a top.  A round is written to a folder that all
    executors share and removed when the next one is there; kept in memory
    alone, its plan would treble with every round.

    A row that still climbs has parents at every smaller distance from its top,
    so some rows arrive in each round.  If none does, the rest is on a cycle.
    """
    spark = df.sparkSession
    at_top = F.col(parent).isNull()
    state = df.select(
        key,
        F.coalesce(parent, key).alias("top"),
        F.when(at_top, 0).otherwise(1).cast("bigint").alias("level"),
        at_top.alias("_done"),
    )
    path = session_path(spark, "levels")
    state, left = written(state, path), None
    while True:
        climbing = state.filter(~F.col("_done"))
        before, left = left, climbing.count()
        if not left:
            return state.drop("_done")
        if left == before:
            discard(spark, path)
            raise ValueError(f"the chains of {parent!r} do not end; they contain a cycle")
        reached = state.select(
            F.col(key).alias("_key"),
            F.col("top").alias("_top"),
            F.col("level").alias("_level"),
            F.col("_done").alias("_reached"),
        )
        moved = climbing.join(reached, F.col("top") == F.col("_key"), "left").select(
            key,
            F.coalesce("_top", "top").alias("top"),
            (F.col("level") + F.coalesce("_level", F.lit(0))).alias("level"),
            F.coalesce("_reached", F.lit(True)).alias("_done"),
        )
        old, path = path, session_path(spark, "levels")
        state = written(state.filter("_done").unionByName(moved), path)
        discard(spark, old)


def hierarchy_totals(
    df: DataFrame, key: str, parent: str, value: str, count: str = "members", out: str = "total"
) -> DataFrame:
    """How many rows each row has below it at any depth, itself included, and
    the total of their values.

    A row knows its ancestor at distance d and the totals of what lies less than
    d below it.  Adding the totals of the rows whose ancestor it is doubles d, so
    a chain of a thousand takes ten rounds of one aggregate and one join each; no
    pair of a row and everyone below it is made.  A parent that is not in the
    table has no totals.  Rounds are written like those of ``hierarchy_levels``.
    """
    spark = df.sparkSession
    rows = df.select(
        key,
        F.col(parent).alias("_up"),
        F.lit(1).cast("bigint").alias(count),
        F.coalesce(F.col(value), F.lit(0)).cast(TOTAL).alias(out),
    )
    path = session_path(spark, "totals")
    state, reach = written(rows, path), 1
    whole = state.count()
    while state.filter(F.col("_up").isNotNull()).limit(1).count():
        if reach > whole:
            discard(spark, path)
            raise ValueError(f"the chains of {parent!r} do not end; they contain a cycle")
        climbing = state.filter(F.col("_up").isNotNull())
        below = climbing.groupBy(F.col("_up").alias("_of")).agg(
            F.sum(count).alias("_count"), total(out).alias("_total")
        )
        above = state.select(F.col(key).alias("_key"), F.col("_up").alias("_next"))
        added = state.join(below, F.col(key) == F.col("_of"), "left")
        moved = added.join(above, F.col("_up") == F.col("_key"), "left").select(
            key,
            F.col("_next").alias("_up"),
            (F.col(count) + F.coalesce("_count", F.lit(0))).alias(count),
            (F.col(out) + F.coalesce("_total", F.lit(0))).cast(TOTAL).alias(out),
        )
        old, path = path, session_path(spark, "totals")
        state, reach = written(moved, path), reach * 2
        discard(spark, old)
    return state.drop("_up")
