"""Tables stored by month of a date column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.functions import in_range, month_start
from grainline.session import discard, exists

PARTITION = "sales_month"
#: Checksums of the months; readers of the table pass over such a folder.
CHECKS = "_checks"


def write_by_month(df: DataFrame, date: str, path: str, mode: str = "errorifexists") -> None:
    """Write one directory per month.

    Rows are gathered by month before the write so that a month is a few large
    files; the rebalance hint lets Spark split a month that is much larger than
    the others.
    """
    by_month = df.withColumn(PARTITION, month_start(date)).hint("rebalance", PARTITION)
    by_month.write.mode(mode).partitionBy(PARTITION).parquet(path)


def refresh_months(df: DataFrame, date: str, path: str) -> list:
    """Bring a table stored by month up to date; only months that changed are written.

    A month's checksum is the number of its rows and the sum of their hashes, from
    one partial aggregate.  Months that differ from what was stored are replaced
    as whole partitions, months that are gone are removed, and the files of all
    others stay as they are.  Returns the changed months.  Checksums are stored
    after the data, so a refresh that was interrupted is made good by the next.
    """
    spark = df.sparkSession
    content = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    sums = df.groupBy(month_start(date).alias(PARTITION)).agg(
        F.count("*").alias("row_count"), F.sum(content).alias("content")
    )
    # One row per month of the calendar.
    now = {r[0]: (r[1], r[2]) for r in sums.collect()}
    checks = f"{path}/{CHECKS}"
    before = {}
    if exists(spark, checks):
        before = {r[0]: (r[1], r[2]) for r in spark.read.parquet(checks).collect()}
    changed = [m for m in now if before.get(m) != now[m]]
    gone = [m for m in before if m not in now]
    if not changed and not gone:
        return []
    if changed:
        month = month_start(date)
        wanted = F.lit(False)
        for m in changed:
            wanted = wanted | month.eqNullSafe(F.lit(m).cast("date"))
        by_month = df.filter(wanted).withColumn(PARTITION, month).hint("rebalance", PARTITION)
        by_month.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            PARTITION
        ).parquet(path)
    for m in gone:
        discard(spark, f"{path}/{PARTITION}={'__HIVE_DEFAULT_PARTITION__' if m is None else m}")
    stored = spark.createDataFrame(
        [(m, *now[m]) for m in now], f"{PARTITION} date, row_count long, content decimal(38,0)"
    )
    stored.coalesce(1).write.mode("overwrite").parquet(checks)
    return sorted(changed + gone, key=str)


def read_months(
    spark: SparkSession, path: str, date: str, start: str, end: str
) -> DataFrame:
    """Rows of the half-open range ``[start, end)``; only its months are read."""
    months = (F.col(PARTITION) >= F.trunc(F.lit(start).cast("date"), "month")) & (
        F.col(PARTITION) < F.lit(end).cast("date")
    )
    stored = spark.read.parquet(path).filter(months)
    return stored.filter(in_range(date, start, end)).drop(PARTITION)


def stored_rows(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table that was written to a folder."""
    return spark.read.parquet(path)
