"""Repeated rows and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions._columns import Names, as_names
from grainline.operators.ranking import top_k_per_group


def duplicates(df: DataFrame, keys: Names, out: str = "duplicate_count") -> DataFrame:
    """Key groups that occur more than once, with their count."""
    counts = df.groupBy(*as_names(keys)).agg(F.count("*").alias(out))
    return counts.filter(F.col(out) > 1)


def dedupe_keep_latest(df: DataFrame, keys: Names, order: str, tie: Names) -> DataFrame:
    """One row per key, the latest by ``order``; the smallest ``tie`` decides equals.

    Each task keeps one row a key before the shuffle, so a group of copies of
    any size is folded where it lies.
    """
    return top_k_per_group(df, keys, order, 1, tie=tie).drop("rnk")


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right).distinct()


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right)


def in_both(left: DataFrame, right: DataFrame, keep_copies: bool = False) -> DataFrame:
    """Rows of both tables, once, or as often as the rarer side has them."""
    right = right.select(*left.columns)
    if keep_copies:
        return left.intersectAll(right)
    return left.distinct().intersect(right.distinct())


def only_left(left: DataFrame, right: DataFrame, keep_copies: bool = False) -> DataFrame:
    """Rows of the left table that the right lacks, or lacks copies of."""
    right = right.select(*left.columns)
    if keep_copies:
        return left.exceptAll(right)
    return left.distinct().subtract(right.distinct())
