"""Top-k, n-th highest and selection by a maximum."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.functions._columns import Names, as_names
from grainline.operators._joins import join_groups
from grainline.operators.ordering import positions

#: Rows per group that each task sorts out before a shuffle, at most.
CUT = 1000


def top_k_per_group(
    df: DataFrame,
    group: Names,
    value: str,
    k: int,
    method: str = "row_number",
    tie: Names = (),
    out: str = "rnk",
    few_ties: bool = False,
) -> DataFrame:
    """The rows with the ``k`` highest values of each group, with their rank.

    ``row_number`` returns at most k rows a group; ``tie`` names the columns
    that order equal values.  ``rank`` and ``dense_rank`` return every tied row.
    Ties are unbounded, so the ranks are found on one row per distinct value and
    joined back.  ``few_ties`` says that hardly any rows of a group tie, as after
    a fold; then the rows are ranked themselves, and read once.  ``out`` is not a column of the frame yet.

    Up to a thousand Spark cuts each task's rows to k per group before the
    shuffle.  A larger k goes by counts: groups are cut into ranges of the order,
    the counts of the ranges tell in which of them the k-th row is, and only rows
    of ranges up to that one are sorted, each range in a task of its own.
    """
    groups = as_names(group)
    highest_first = F.col(value).desc_nulls_last()
    if method == "row_number":
        ties = as_names(tie)
        if k > CUT:
            found = positions(df, groups, [f"-{value}", *ties], out, limit=k)
            return found.withColumn(out, F.col(out).cast("int"))
        order = [highest_first, *[F.col(t).asc_nulls_last() for t in ties]]
        number = F.row_number().over(W.partitionBy(*groups).orderBy(*order))
        return df.withColumn(out, number).filter(F.col(out) <= k)
    if method not in ("rank", "dense_rank"):
        raise ValueError(f"unknown method {method!r}")
    window = W.partitionBy(*groups).orderBy(highest_first)
    if few_ties and k <= CUT:
        ranked = F.rank() if method == "rank" else F.dense_rank()
        return df.withColumn(out, ranked.over(window)).filter(F.col(out) <= k)
    values = df.groupBy(*groups, value).agg(F.count("*").alias("_n"))
    if k > CUT:
        weight = "_n" if method == "rank" else None
        ranked = positions(values, groups, [f"-{value}"], out, weight, limit=k)
        ranked = ranked.withColumn(out, F.col(out).cast("int"))
        return join_groups(df, ranked.drop("_n"), [*groups, value])
    ranked = values.withColumn(out, F.row_number().over(window)).filter(F.col(out) <= k)
    if method == "rank":
        before = F.sum("_n").over(window.rowsBetween(W.unboundedPreceding, -1))
        rank = (F.coalesce(before, F.lit(0)) + 1).cast("int")
        ranked = ranked.withColumn(out, rank).filter(F.col(out) <= k)
    return join_groups(df, ranked.drop("_n"), [*groups, value])


def top_k(df: DataFrame, value: str, k: int, tie: Names = ()) -> DataFrame:
    """The ``k`` highest rows overall, kept as a small heap in every task."""
    ties = [F.col(t).asc_nulls_last() for t in as_names(tie)]
    return df.orderBy(F.col(value).desc_nulls_last(), *ties).limit(k)


def nth_highest(df: DataFrame, value: str, n: int, out: str = "nth_highest") -> DataFrame:
    """One row with the n-th highest distinct value, NULL where there is none."""
    present = df.select(F.col(value).alias("_value")).filter(F.col("_value").isNotNull())
    highest = present.distinct().orderBy(F.col("_value").desc()).limit(n)
    found = F.count("*") == n
    return highest.agg(F.when(found, F.min("_value")).alias(out))


def rows_at_nth_highest(df: DataFrame, value: str, n: int) -> DataFrame:
    """Every row that holds the n-th highest distinct value; none where there is none."""
    return df.filter(F.col(value) == nth_highest(df, value, n).scalar())


def peers_of_max(df: DataFrame, group: str, value: str) -> DataFrame:
    """All rows of the groups in which the overall maximum occurs, each row once."""
    highest = df.agg(F.max(value)).scalar()
    groups = df.filter(F.col(value) == highest).select(group).distinct()
    return df.join(groups, group, "left_semi")
