"""Column functions shared by the operators and the reports."""

from grainline.functions.dates import (
    adjacent,
    days_between,
    in_range,
    in_year,
    month_start,
    months_after,
    months_before,
    next_day,
    period_start,
    quarter_of,
    units_between,
    year_of,
)
from grainline.functions.measures import (
    MEAN,
    MONEY,
    PERCENT,
    TOTAL,
    annual_salary,
    exact,
    growth_flag,
    growth_pct,
    mean,
    money,
    or_zero,
    percent,
    total,
)

__all__ = [
    "MEAN",
    "MONEY",
    "PERCENT",
    "TOTAL",
    "adjacent",
    "annual_salary",
    "exact",
    "days_between",
    "growth_flag",
    "growth_pct",
    "in_range",
    "in_year",
    "mean",
    "money",
    "month_start",
    "months_after",
    "months_before",
    "next_day",
    "or_zero",
    "percent",
    "period_start",
    "quarter_of",
    "total",
    "units_between",
    "year_of",
]
