"""Salesperson reports.

``fact`` has salesperson_id, order_date and sales_amount; ``dim`` has one row
per salesperson with salesperson_id, salesperson_name, region.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions import growth_pct, quarter_of, total, year_of
from grainline.operators import (
    period_revenue,
    rolling,
    share_of_group,
    top_k_per_group,
    with_previous,
    with_run_length,
)

KEY = "salesperson_id"
ATTRIBUTES = ["salesperson_name", "region"]


def salesperson_performance(
    fact: DataFrame,
    dim: DataFrame,
    min_streak: int = 3,
    min_share: float = 10,
    top: int = 3,
    as_of: str | None = None,
    with_rolling: bool = False,
    extra: bool = False,
) -> DataFrame:
    """Growing salespeople with a large share of their region, best per region.

    Months fold into quarters, quarters into years and years into one row per
    salesperson; the first two keep the salesperson's partitioning, so nothing
    is shuffled between them.  ``as_of`` leaves out sales from that day on, as
    a partial last year would be compared with a full one.  ``with_rolling``
    adds the rolling average of the latest month, ``extra`` its growth.
    """
    if as_of is not None:
        fact = fact.filter(F.col("order_date") < F.lit(as_of).cast("date"))
    monthly = period_revenue(fact, KEY)
    rows = with_previous(monthly, KEY, "sales_month", "monthly_revenue")
    rows = rolling(
        rows, KEY, "sales_month", "monthly_revenue", digits=None, out="rolling_3_month_revenue"
    )
    rows = with_run_length(rows, KEY, "sales_month", "monthly_revenue")

    def latest(column: str, by: str):
        return F.max_by(column, by).alias(column)

    carried = ["rolling_3_month_revenue", "monthly_revenue", "previous_monthly_revenue"]
    quarters = rows.groupBy(
        KEY, year_of("sales_month").alias("sales_year"), quarter_of("sales_month").alias("quarter")
    ).agg(
        total("monthly_revenue").alias("quarterly_revenue"),
        F.max("run_length").alias("run_length"),
        *[latest(c, "sales_month") for c in carried],
    )
    earliest_best = F.struct("quarterly_revenue", -F.col("quarter"))
    years = quarters.groupBy(KEY, "sales_year").agg(
        total("quarterly_revenue").alias("yearly_revenue"),
        F.max("quarterly_revenue").alias("best_revenue"),
        F.max_by("quarter", earliest_best).alias("best_quarter"),
        F.max("run_length").alias("run_length"),
        *[latest(c, "quarter") for c in carried],
    )
    years = with_previous(years, KEY, "sales_year", "yearly_revenue")
    earliest_best = F.struct("best_revenue", -F.col("sales_year"))
    people = years.groupBy(KEY).agg(
        F.max("run_length").alias("longest_growth_streak"),
        total("yearly_revenue").alias("lifetime_revenue"),
        F.max_by("best_quarter", earliest_best).alias("sales_quarter"),
        F.max("best_revenue").alias("highest_quarterly_revenue"),
        latest("yearly_revenue", "sales_year"),
        latest("previous_yearly_revenue", "sales_year"),
        *[latest(c, "sales_year") for c in carried],
        F.max("sales_year").alias("sales_year"),
    )
    shared = share_of_group(
        people.join(dim.select(KEY, *ATTRIBUTES), KEY),
        "region",
        "lifetime_revenue",
        out="regional_contribution_pct",
    )
    measured = shared.withColumns(
        {
            "yoy_growth": growth_pct("yearly_revenue", "previous_yearly_revenue"),
            "mom_growth": growth_pct("monthly_revenue", "previous_monthly_revenue"),
        }
    )
    kept = measured.filter(
        (F.col("longest_growth_streak") >= min_streak)
        & (F.col("yoy_growth") > 0)
        & (F.col("regional_contribution_pct") >= min_share)
    )
    ranked = top_k_per_group(
        kept, "region", "yearly_revenue", top, tie=KEY, out="regional_rank"
    )
    columns = [
        KEY,
        *ATTRIBUTES,
        "longest_growth_streak",
        "sales_year",
        "yearly_revenue",
        "yoy_growth",
        *(["rolling_3_month_revenue"] if with_rolling else []),
        *(["mom_growth"] if extra else []),
        "sales_quarter",
        "highest_quarterly_revenue",
        "regional_contribution_pct",
        "regional_rank",
    ]
    return ranked.select(*columns).orderBy("region", "regional_rank")


def regional_performance(fact: DataFrame, dim: DataFrame, **parameters) -> DataFrame:
    """The same report with the rolling average of the latest month."""
    return salesperson_performance(fact, dim, with_rolling=True, **parameters)
