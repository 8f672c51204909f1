"""Roll-ups of a fact table to entity and period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.functions import mean, period_start, quarter_of, total, year_of
from grainline.functions._columns import Names, as_names


def period_revenue(
    fact: DataFrame,
    key: Names = "customer_id",
    date: str = "order_date",
    value: str = "sales_amount",
    grain: str | None = "month",
    dim: DataFrame | None = None,
    attrs: Names = (),
    period: str = "sales_month",
    revenue: str = "monthly_revenue",
) -> DataFrame:
    """One row per entity and active period with the summed value.

    The fact rows are summed before anything is attached to them: the map side
    folds repeated keys, so a key that holds a large part of the table arrives
    as a few partial sums.  Attributes of ``dim`` are joined to the summed rows.
    With ``grain=None`` there is one row per entity.
    """
    keys = as_names(key)
    columns = [F.col(k) for k in keys]
    if grain is not None:
        columns.append(period_start(date, grain).alias(period))
    rolled = fact.groupBy(*columns).agg(total(value).alias(revenue))
    if dim is None:
        return rolled
    return rolled.join(dim.select(*keys, *as_names(attrs)), keys)


def rollup_years(
    monthly: DataFrame,
    key: Names,
    period: str = "sales_month",
    value: str = "monthly_revenue",
    by_quarter: bool = False,
    out: str | None = None,
) -> DataFrame:
    """Re-aggregate month rows to years, or to quarters of years."""
    columns: list[Column | str] = [*as_names(key), year_of(period).alias("sales_year")]
    if by_quarter:
        columns.append(quarter_of(period).alias("sales_quarter"))
    out = out or ("quarterly_revenue" if by_quarter else "yearly_revenue")
    return monthly.groupBy(*columns).agg(total(value).alias(out))


def group_sum(df: DataFrame, group: Names, value: str, out: str) -> DataFrame:
    return df.groupBy(*as_names(group)).agg(total(value).alias(out))


def groups_where_average(
    df: DataFrame, group: Names, value: str, above: float | int | str, out: str
) -> DataFrame:
    """Groups whose average over the non-NULL values lies above a bound."""
    present = df.filter(F.col(value).isNotNull())
    return present.groupBy(*as_names(group)).agg(mean(value).alias(out)).filter(F.col(out) > above)
