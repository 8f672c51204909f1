"""Balance movements and parametrised statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.functions import TOTAL, or_zero, total
from grainline.operators.lookups import never_matched


def apply_adjustments(
    balances: DataFrame,
    deltas: DataFrame,
    key: str = "account_id",
    balance: str = "balance",
    delta: str = "delta",
) -> DataFrame:
    """Balances after all movements; accounts without one are unchanged.

    The movements are summed per account first, so one busy account is a single
    row by the time it is joined.  Movements of an account that has no balance
    yet make up a row of their own, with NULL in all other columns, so nothing
    that was paid is lost.  The input stays as it is.
    """
    moved = deltas.groupBy(key).agg(total(delta).alias("_moved"))
    joined = balances.join(moved, key, "left")
    known = joined.withColumn(
        balance, (F.col(balance) + or_zero("_moved")).cast(TOTAL)
    ).drop("_moved")
    opened = never_matched(moved, balances, key).select(key, F.col("_moved").alias(balance))
    return known.unionByName(opened, allowMissingColumns=True)


def transfers(
    pairs: DataFrame, source: str, target: str, amount: str, key: str = "account_id"
) -> DataFrame:
    """Two movements per transfer, which add up to zero."""
    sides = F.array(
        F.struct(F.col(source).alias(key), (-F.col(amount)).alias("delta")),
        F.struct(F.col(target).alias(key), F.col(amount).alias("delta")),
    )
    return pairs.select(F.inline(sides))


def run_statement(
    spark: SparkSession, statement: str, tables: dict[str, DataFrame], **parameters: object
) -> DataFrame:
    """Run a SQL text with named parameters and named input frames.

    Values are bound as ``:name`` and frames as ``{name}``; nothing is pasted
    into the text.
    """
    return spark.sql(statement, args=parameters, **tables)
