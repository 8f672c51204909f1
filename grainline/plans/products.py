"""Product reports.

``fact`` has product_id, order_date and sales_amount; ``dim`` has one row per
product with product_id, product_name, category.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions import growth_pct, total
from grainline.operators import (
    period_revenue,
    share_of_group,
    top_k_per_group,
    with_previous,
    with_run_length,
)

KEY = "product_id"
ATTRIBUTES = ["product_name", "category"]


def top_products(fact: DataFrame, dim: DataFrame, top: int = 3) -> DataFrame:
    """Best products of each category with their share of its revenue."""
    products = period_revenue(
        fact, KEY, grain=None, dim=dim, attrs=ATTRIBUTES, revenue="total_revenue"
    )
    shared = share_of_group(
        products, "category", "total_revenue", out="category_revenue_percentage"
    )
    ranked = top_k_per_group(
        shared, "category", "total_revenue", top, tie=KEY, out="category_rank"
    )
    return ranked.select(
        "category",
        KEY,
        "product_name",
        "total_revenue",
        "category_revenue_percentage",
        "category_rank",
    ).orderBy("category", "category_rank")


def product_dominance(
    fact: DataFrame,
    dim: DataFrame,
    min_share: float = 10,
    min_streak: int = 3,
    top: int = 3,
    with_category_revenue: bool = True,
) -> DataFrame:
    """Growing products above their category's average, best per category.

    The category performance report is the same with ``min_share=15`` and
    without the category revenue.
    """
    monthly = period_revenue(fact, KEY)
    rows = with_previous(monthly, KEY, "sales_month", "monthly_revenue")
    rows = with_run_length(rows, KEY, "sales_month", "monthly_revenue")
    products = rows.groupBy(KEY).agg(
        total("monthly_revenue").alias("lifetime_revenue"),
        F.max("run_length").alias("longest_growth_streak"),
        F.max("sales_month").alias("latest_month"),
        F.max_by("monthly_revenue", "sales_month").alias("latest_month_revenue"),
        F.max_by("previous_monthly_revenue", "sales_month").alias("previous_revenue"),
    )
    shared = share_of_group(
        products.join(dim.select(KEY, *ATTRIBUTES), KEY),
        "category",
        "lifetime_revenue",
        out="category_contribution_pct",
        total_out="category_revenue",
        average_out="category_avg_revenue",
        count_out="products",
    )
    latest_growth = growth_pct("latest_month_revenue", "previous_revenue")
    kept = shared.filter(
        (F.col("lifetime_revenue") * F.col("products") > F.col("category_revenue"))
        & (F.col("category_contribution_pct") >= min_share)
        & (F.col("longest_growth_streak") >= min_streak)
        & (latest_growth > 0)
    ).withColumn("latest_mom_growth", latest_growth)
    ranked = top_k_per_group(
        kept, "category", "lifetime_revenue", top, tie=KEY, out="category_rank"
    )
    columns = [
        KEY,
        *ATTRIBUTES,
        "lifetime_revenue",
        *(["category_revenue"] if with_category_revenue else []),
        "category_avg_revenue",
        "category_contribution_pct",
        "longest_growth_streak",
        "latest_month",
        "latest_month_revenue",
        "latest_mom_growth",
        "category_rank",
    ]
    return ranked.select(*columns).orderBy("category", "category_rank")


def category_performance(
    fact: DataFrame, dim: DataFrame, min_share: float = 15, min_streak: int = 3, top: int = 3
) -> DataFrame:
    """Dominant products of each category."""
    report = product_dominance(fact, dim, min_share, min_streak, top, with_category_revenue=False)
    return report.withColumnRenamed("category_avg_revenue", "category_average_revenue")
