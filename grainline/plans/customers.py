"""Customer reports.

``fact`` has customer_id, order_date and sales_amount at any grain; ``dim``
has one row per customer with customer_id, customer_name, segment, region.
Each report folds the month rows of a customer into one row with a single
aggregate instead of joining one intermediate table per measure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.functions import growth_pct, month_start, total, units_between
from grainline.operators import (
    cohort_shares,
    period_revenue,
    rolling,
    running,
    top_k_per_group,
    with_previous,
    with_run_length,
)
from grainline.operators.timeseries import along

KEY = "customer_id"
ATTRIBUTES = ["customer_name", "segment", "region"]


def at_latest(column: str, period: str = "sales_month"):
    """Aggregate: value of a column in the latest period."""
    return F.max_by(column, period)


def _settled(customers: DataFrame) -> DataFrame:
    """Shuffle the finished customer rows before they are sorted.

    A sort first samples its input to choose ranges; without this cut the
    sampling would run all windows over the month rows a second time.
    """
    return customers.hint("rebalance", KEY)


def customer_monthly_performance(
    fact: DataFrame, dim: DataFrame, min_streak: int = 3, extra: bool = False
) -> DataFrame:
    """Customers with a long run of rising months whose latest month rose too.

    ``extra`` adds the running revenue.
    """
    monthly = period_revenue(fact, KEY)
    rows = with_previous(monthly, KEY, "sales_month", "monthly_revenue")
    rows = rolling(rows, KEY, "sales_month", "monthly_revenue", out="rolling_avg_3m")
    rows = with_run_length(rows, KEY, "sales_month", "monthly_revenue")
    customers = rows.groupBy(KEY).agg(
        F.max("sales_month").alias("latest_month"),
        at_latest("monthly_revenue").alias("latest_month_revenue"),
        at_latest("previous_monthly_revenue").alias("previous_month_revenue"),
        at_latest("rolling_avg_3m").alias("rolling_avg_3m"),
        F.max("run_length").alias("longest_monthly_streak"),
        total("monthly_revenue").alias("running_revenue"),
    )
    kept = customers.filter(
        (F.col("longest_monthly_streak") >= min_streak)
        & (F.col("latest_month_revenue") > F.col("previous_month_revenue"))
    ).join(dim.select(KEY), KEY, "left_semi")
    columns = [
        KEY,
        "latest_month",
        "latest_month_revenue",
        "previous_month_revenue",
        growth_pct("latest_month_revenue", "previous_month_revenue").alias("mom_growth"),
        "rolling_avg_3m",
        "longest_monthly_streak",
    ]
    if extra:
        columns.append("running_revenue")
    return _settled(kept.select(*columns)).orderBy(
        F.col("longest_monthly_streak").desc_nulls_last(),
        F.col("latest_month_revenue").desc_nulls_last(),
        KEY,
    )


def _days(fact: DataFrame) -> DataFrame:
    """Revenue per customer and day, the only place where the fact is read."""
    return period_revenue(fact, KEY, grain="day", period="order_day", revenue="day_revenue")


def _activity_profiles(daily: DataFrame, min_gap_days: int, return_months: int) -> DataFrame:
    """One row per customer with streaks, gaps, returns and lifetime revenue.

    Days carry the gaps and roll up to months without another shuffle, since
    both are partitioned by customer.  The key leaves the last aggregate as a
    value: a later join then tests it above the day rows and not below, and
    their shuffle stays the same one that the average reads.
    """
    gap = F.datediff("order_day", F.lag("order_day").over(along(KEY, "order_day")))
    monthly = (
        daily.withColumn("_gap", gap)
        .groupBy(KEY, month_start("order_day").alias("sales_month"))
        .agg(
            total("day_revenue").alias("monthly_revenue"),
            F.max("_gap").alias("_gap"),
            F.count_if(F.col("_gap") >= min_gap_days).alias("_long_gaps"),
        )
    )
    rows = with_previous(monthly, KEY, "sales_month", ["sales_month", "monthly_revenue"])
    for mode in ("growth", "activity"):
        rows = with_run_length(
            rows,
            KEY,
            "sales_month",
            "monthly_revenue",
            mode,
            out=f"_{mode}",
            start=f"_{mode}_start",
        )
    returned = F.col("sales_month") >= F.add_months("previous_sales_month", return_months)
    profiles = rows.groupBy(F.col(KEY).alias("_group")).agg(
        F.max(KEY).alias(KEY),
        total("monthly_revenue").alias("lifetime_revenue"),
        F.max("_growth").alias("longest_growth_streak"),
        F.max("_activity").alias("longest_activity_streak"),
        F.max("_gap").alias("max_inactive_days"),
        F.sum("_long_gaps").alias("long_gaps"),
        F.count("*").alias("active_months"),
        F.count_if(F.coalesce(returned, F.lit(False))).alias("month_returns"),
        F.max(F.datediff("sales_month", "previous_sales_month")).alias("max_month_gap_days"),
        F.max("sales_month").alias("latest_month"),
        at_latest("monthly_revenue").alias("latest_month_revenue"),
        at_latest("previous_monthly_revenue").alias("previous_revenue"),
    )
    return profiles.drop("_group")


def _above_average_lifetime(profiles: DataFrame, daily: DataFrame) -> DataFrame:
    """Profiles above the average lifetime revenue of all customers of the fact."""
    lifetimes = period_revenue(daily, KEY, value="day_revenue", grain=None, revenue="lifetime")
    overall = lifetimes.agg(
        F.struct(F.sum("lifetime").alias("s"), F.count("lifetime").alias("n"))
    ).scalar()
    return profiles.filter(F.col("lifetime_revenue") * overall["n"] > overall["s"])


def customer_lifecycle(
    fact: DataFrame,
    dim: DataFrame,
    min_streak: int = 3,
    min_gap_days: int = 60,
    top: int = 5,
    streak: str = "growth",
) -> DataFrame:
    """Valuable customers who paused, came back and are growing, best per region.

    ``streak="activity"`` counts consecutive months instead of increases.
    """
    daily = _days(fact)
    profiles = _activity_profiles(daily, min_gap_days, return_months=3)
    latest_growth = growth_pct("latest_month_revenue", "previous_revenue")
    kept = _above_average_lifetime(profiles, daily).filter(
        (F.col(f"longest_{streak}_streak") >= min_streak)
        & (F.col("max_inactive_days") >= min_gap_days)
        & (F.col("long_gaps") >= 1)
        & (latest_growth > 0)
    )
    named = kept.join(dim.select(KEY, *ATTRIBUTES), KEY).select(
        KEY,
        *ATTRIBUTES,
        "lifetime_revenue",
        F.col(f"longest_{streak}_streak").alias("longest_monthly_streak"),
        "max_inactive_days",
        F.col("long_gaps").alias("reactivation_count"),
        "latest_month",
        "latest_month_revenue",
        latest_growth.alias("latest_mom_growth"),
    )
    ranked = top_k_per_group(
        named, "region", "lifetime_revenue", top, tie=KEY, out="regional_rank"
    )
    return ranked.orderBy("region", "regional_rank")


def customer_cohorts(fact: DataFrame, dim: DataFrame, extra: bool = False) -> DataFrame:
    """Every customer with cohort, age, cumulative, rolling and best month.

    ``extra`` adds whether the customer ever bought in three months in a row.
    """
    monthly = period_revenue(fact, KEY)
    rows = rolling(monthly, KEY, "sales_month", "monthly_revenue", out="rolling_3_month_revenue")
    rows = running(rows, KEY, "sales_month", "monthly_revenue", out="cumulative_revenue")
    rows = with_run_length(rows, KEY, "sales_month", mode="activity")
    # The first month with the highest revenue is the last one to set a record.
    record = F.max("monthly_revenue").over(
        along(KEY, "sales_month").rowsBetween(W.unboundedPreceding, -1)
    )
    sets_record = F.col("_record").isNull() | (F.col("monthly_revenue") > F.col("_record"))
    rows = rows.withColumn("_record", record)
    customers = rows.groupBy(KEY).agg(
        F.min("sales_month").alias("cohort_month"),
        total("monthly_revenue").alias("lifetime_revenue"),
        F.max("sales_month").alias("latest_month"),
        at_latest("monthly_revenue").alias("latest_month_revenue"),
        at_latest("cumulative_revenue").alias("cumulative_revenue"),
        at_latest("rolling_3_month_revenue").alias("rolling_3_month_revenue"),
        F.max("monthly_revenue").alias("highest_monthly_revenue"),
        F.max(F.when(sets_record, F.col("sales_month"))).alias("highest_revenue_month"),
        F.max("run_length").alias("longest_purchase_streak"),
    )
    known = customers.join(dim.select(KEY, *ATTRIBUTES), KEY)
    columns = [
        KEY,
        *ATTRIBUTES,
        "cohort_month",
        "lifetime_revenue",
        "latest_month",
        "latest_month_revenue",
        units_between("cohort_month", "latest_month").alias("months_since_first_purchase"),
        "cumulative_revenue",
        "rolling_3_month_revenue",
        "highest_monthly_revenue",
        "highest_revenue_month",
        "cohort_revenue_percentage",
        "longest_purchase_streak",
    ]
    if extra:
        columns.append((F.col("longest_purchase_streak") >= 3).alias("has_3_month_streak"))
    members = customers.join(dim.select(KEY), KEY, "left_semi")
    shared = cohort_shares(known, members=members)
    return _settled(shared.select(*columns)).orderBy(KEY)


def customer_retention(
    fact: DataFrame,
    dim: DataFrame,
    min_months: int = 4,
    min_gap_days: int = 60,
    return_months: int = 3,
    min_returns: int = 1,
    min_streak: int = 3,
    top: int = 5,
    extra: bool = False,
) -> DataFrame:
    """Loyal, valuable customers who left and returned, best per region.

    ``extra`` adds the longest distance between two active months.
    """
    daily = _days(fact)
    profiles = _activity_profiles(daily, min_gap_days, return_months)
    kept = _above_average_lifetime(profiles, daily).filter(
        (F.col("active_months") >= min_months)
        & (F.col("max_inactive_days") >= min_gap_days)
        & (F.col("month_returns") >= min_returns)
        & (F.col("longest_activity_streak") >= min_streak)
    )
    columns = [
        KEY,
        *ATTRIBUTES,
        "lifetime_revenue",
        "active_months",
        "max_inactive_days",
        F.col("month_returns").alias("reactivation_count"),
        F.col("longest_activity_streak").alias("longest_purchase_streak"),
    ]
    if extra:
        columns.append("max_month_gap_days")
    named = kept.join(dim.select(KEY, *ATTRIBUTES), KEY).select(*columns)
    ranked = top_k_per_group(
        named, "region", "lifetime_revenue", top, tie=KEY, out="regional_rank"
    )
    return ranked.orderBy("region", "regional_rank")
