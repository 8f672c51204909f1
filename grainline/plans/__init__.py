"""The ten reports, composed from the operators."""

from grainline.plans.attendance import attendance_streaks
from grainline.plans.customers import (
    customer_cohorts,
    customer_lifecycle,
    customer_monthly_performance,
    customer_retention,
)
from grainline.plans.products import category_performance, product_dominance, top_products
from grainline.plans.salespeople import regional_performance, salesperson_performance

__all__ = [
    "attendance_streaks",
    "category_performance",
    "customer_cohorts",
    "customer_lifecycle",
    "customer_monthly_performance",
    "customer_retention",
    "product_dominance",
    "regional_performance",
    "salesperson_performance",
    "top_products",
]
