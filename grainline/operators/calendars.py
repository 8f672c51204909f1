"""Activity kept as bits of a calendar, and runs of days as sessions.

A month is one bit, so the months of an entity are a few words whatever its rows
are.  ``bit_or`` merges them in every task before the one shuffle, and streaks,
returns and retention are read off the bits: nothing is sorted and no window runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.functions import days_between, percent, units_between
from grainline.functions._columns import Names, as_names

WORD = 64
BITS = "month_bits"


def month_bits(df: DataFrame, key: Names, date: str, since: str, months: int = 256) -> DataFrame:
    """One row per entity with its active months as bits; bit 0 is the month ``since``.

    ``months`` is the length of the calendar, rounded up to whole words.  A date
    outside of it is an error; rows without a date set no bit.
    """
    words = -(-months // WORD)
    at = units_between(F.trunc(F.lit(since).cast("date"), "month"), date)
    outside = F.concat(F.lit("date outside of the calendar: "), F.col(date).cast("string"))
    inside = F.when(at.between(0, words * WORD - 1) | at.isNull(), at).otherwise(F.raise_error(outside).cast("int"))
    rows = df.select(*as_names(key), inside.alias("_at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("_at", F.lit(WORD)))

    def word(i: int) -> Column:
        mine = F.floor(F.col("_at") / WORD) == i
        return F.bit_or(F.when(mine, bit).otherwise(F.lit(0).cast("bigint")))

    return rows.groupBy(*as_names(key)).agg(F.array(*[word(i) for i in range(words)]).alias(BITS))


def _is_set(at: Column) -> Column:
    word = F.get(F.col(BITS), F.floor(at / WORD).cast("int"))
    return F.coalesce(F.getbit(word, F.pmod(at, F.lit(WORD))) == 1, F.lit(False))


def _active() -> Column:
    """Numbers of the active months, ascending."""
    return F.filter(F.sequence(F.lit(0), F.size(BITS) * WORD - 1), _is_set)


def _month(since: str, at: Column) -> Column:
    return F.add_months(F.trunc(F.lit(since).cast("date"), "month"), at)


def streaks_of_bits(bits: DataFrame, key: Names, since: str) -> DataFrame:
    """One row per unbroken run of active months, as ``streaks`` gives them."""
    active = bits.withColumn("_active", _active())
    runs = active.select(
        *as_names(key),
        F.filter("_active", lambda at: ~_is_set(at - 1)).alias("_starts"),
        F.filter("_active", lambda at: ~_is_set(at + 1)).alias("_ends"),
    )
    flat = runs.select(*as_names(key), F.inline(F.arrays_zip("_starts", "_ends")))
    return flat.select(
        *as_names(key),
        _month(since, F.col("_starts")).alias("run_start"),
        _month(since, F.col("_ends")).alias("run_end"),
        (F.col("_ends") - F.col("_starts") + 1).cast("bigint").alias("streak_length"),
    )


def returns_of_bits(bits: DataFrame, key: Names, since: str, months: int = 3) -> DataFrame:
    """Active months and returns after a pause, as ``month_reactivations`` gives them."""
    active = bits.withColumn("_active", _active()).filter(F.size("_active") > 0)
    steps = F.arrays_zip(
        F.slice("_active", F.lit(1), F.size("_active") - 1).alias("a"),
        F.slice("_active", F.lit(2), F.size("_active") - 1).alias("b"),
    )
    steps = active.withColumn("_steps", steps)
    came_back = F.filter("_steps", lambda s: s["b"] - s["a"] >= months)
    days = F.transform("_steps", lambda s: days_between(_month(since, s["a"]), _month(since, s["b"])))
    return steps.select(
        *as_names(key),
        F.size("_active").cast("bigint").alias("active_months"),
        F.size(came_back).cast("bigint").alias("reactivation_count"),
        F.array_max(days).alias("max_month_gap_days"),
    )


def retention_of_bits(bits: DataFrame, since: str) -> DataFrame:
    """Active entities per cohort and month since, as ``cohort_retention`` gives them."""
    active = bits.withColumn("_active", _active()).filter(F.size("_active") > 0)
    first = F.get("_active", F.lit(0))
    aged = active.select(first.alias("_first"), F.explode("_active").alias("_at"))
    counts = aged.groupBy("_first", (F.col("_at") - F.col("_first")).alias("months_since_first")).agg(
        F.count("*").alias("active_entities")
    )
    # At most one row per pair of months: the months of a cohort are one map.
    cohorts = counts.groupBy("_first").agg(
        F.collect_list(F.struct("months_since_first", "active_entities")).alias("_ages"),
        F.max("active_entities").alias("cohort_size"),
    )
    flat = cohorts.select("_first", "cohort_size", F.inline("_ages"))
    return flat.select(
        _month(since, F.col("_first")).alias("cohort_month"),
        "months_since_first",
        "active_entities",
        "cohort_size",
        percent("active_entities", "cohort_size").alias("retention_pct"),
    )


def day_streaks(df: DataFrame, key: Names, date: str) -> DataFrame:
    """One row per unbroken run of days, as ``streaks`` gives them.

    Days are distinct in every task before the shuffle.  A session ends where no
    day follows within a day and a half, so the next day goes on with it and the
    day after that doesn't, also where clocks change.
    """
    keys = as_names(key)
    days = df.select(*keys, date).filter(F.col(date).isNotNull()).distinct()
    session = F.session_window(F.col(date).cast("timestamp"), "36 hours")
    return (
        days.groupBy(*keys, session.alias("_session"))
        .agg(F.min(date).alias("run_start"), F.max(date).alias("run_end"), F.count("*").alias("streak_length"))
        .drop("_session")
    )
