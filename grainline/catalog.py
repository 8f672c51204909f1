"""Every operator and report bound to the retail tables, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline import operators as op
from grainline import plans
from grainline import sources as src
from grainline.functions import (
    MEAN,
    annual_salary,
    growth_flag,
    growth_pct,
    in_year,
    mean,
    month_start,
    or_zero,
    total,
)
from grainline.session import session_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

FULL_YEARS_END = "2001-01-01"


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _customer_months(spark: SparkSession, folder: str) -> DataFrame:
    return op.period_revenue(src.order_sales(spark, folder))


def _product_months(spark: SparkSession, folder: str) -> DataFrame:
    return op.period_revenue(src.product_sales(spark, folder), "product_id")


def _seller_months(spark: SparkSession, folder: str) -> DataFrame:
    return op.period_revenue(src.seller_sales(spark, folder), "salesperson_id")


# Roll-ups


@register
def period_revenue(spark: SparkSession, folder: str) -> DataFrame:
    return op.period_revenue(
        src.order_sales(spark, folder),
        dim=src.dim_customers(spark, folder),
        attrs=["segment", "region"],
    ).select("customer_id", "segment", "region", "sales_month", "monthly_revenue")


@register
def period_revenue_total(spark: SparkSession, folder: str) -> DataFrame:
    return op.period_revenue(
        src.product_sales(spark, folder, dated=False),
        "product_id",
        grain=None,
        dim=src.dim_products(spark, folder),
        attrs="category",
        revenue="total_revenue",
    ).select("product_id", "category", "total_revenue")


@register
def active_months(spark: SparkSession, folder: str) -> DataFrame:
    sales = src.sold_orders(spark, folder)
    return sales.select("customer_id", month_start("order_date").alias("sales_month")).distinct()


@register
def revenue_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return op.rollup_years(_seller_months(spark, folder), "salesperson_id")


@register
def revenue_by_quarter(spark: SparkSession, folder: str) -> DataFrame:
    return op.rollup_years(_seller_months(spark, folder), "salesperson_id", by_quarter=True)


@register
def sales_summary(spark: SparkSession, folder: str) -> DataFrame:
    return src.orders(spark, folder).agg(
        F.count("*").alias("order_count"),
        total("amount").alias("total_amount"),
        mean("amount").alias("average_amount"),
        F.max("amount").alias("highest_amount"),
        F.min("order_date").alias("first_day"),
    )


@register
def average_lifetime(spark: SparkSession, folder: str) -> DataFrame:
    lifetimes = op.period_revenue(src.order_sales(spark, folder), grain=None, revenue="lifetime")
    return lifetimes.agg(mean("lifetime").alias("avg_revenue"))


@register
def departments_above_average_salary(spark: SparkSession, folder: str) -> DataFrame:
    return op.groups_where_average(
        src.employees(spark, folder), "dept", "salary", above=4500, out="avg_salary"
    )


# Periods


@register
def monthly_growth(spark: SparkSession, folder: str) -> DataFrame:
    rows = op.with_previous(
        _customer_months(spark, folder),
        "customer_id",
        "sales_month",
        ["sales_month", "monthly_revenue"],
    )
    current, previous = "monthly_revenue", "previous_monthly_revenue"
    return rows.withColumns(
        {
            "mom_growth": growth_pct(current, previous),
            "growth_flag": growth_flag(current, previous, "sales_month", "previous_sales_month"),
        }
    )


@register
def growth_streaks(spark: SparkSession, folder: str) -> DataFrame:
    return op.streaks(
        _product_months(spark, folder), "product_id", "sales_month", "monthly_revenue"
    )


@register
def longest_growth_streak(spark: SparkSession, folder: str) -> DataFrame:
    return op.longest_streak(
        _customer_months(spark, folder), "customer_id", "sales_month", "monthly_revenue"
    )


@register
def activity_streaks_by_month(spark: SparkSession, folder: str) -> DataFrame:
    months = active_months(spark, folder)
    return op.streaks(months, "customer_id", "sales_month", mode="activity")


@register
def activity_streaks_by_day(spark: SparkSession, folder: str) -> DataFrame:
    present = src.attendance(spark, folder).filter(F.col("attendance_status") == "Present")
    days = present.select("employee_id", "attendance_date").distinct()
    return op.streaks(days, "employee_id", "attendance_date", mode="activity", unit="day")


#: First month of the calendars that hold activity as bits.
CALENDAR = "1995-01-01"


def _bits(spark: SparkSession, folder: str) -> DataFrame:
    return op.month_bits(src.sold_orders(spark, folder), "customer_id", "order_date", CALENDAR)


@register
def activity_streaks_by_bits(spark: SparkSession, folder: str) -> DataFrame:
    return op.streaks_of_bits(_bits(spark, folder), "customer_id", CALENDAR)


@register
def activity_streaks_by_session(spark: SparkSession, folder: str) -> DataFrame:
    present = src.attendance(spark, folder).filter(F.col("attendance_status") == "Present")
    return op.day_streaks(present, "employee_id", "attendance_date")


@register
def rolling_average(spark: SparkSession, folder: str) -> DataFrame:
    return op.rolling(
        _customer_months(spark, folder),
        "customer_id",
        "sales_month",
        "monthly_revenue",
        out="rolling_avg_3m",
    )


@register
def rolling_sum(spark: SparkSession, folder: str) -> DataFrame:
    return op.rolling(
        _product_months(spark, folder),
        "product_id",
        "sales_month",
        "monthly_revenue",
        fn="sum",
        digits=None,
        out="rolling_sum_3m",
    )


@register
def latest_month(spark: SparkSession, folder: str) -> DataFrame:
    return op.latest(_customer_months(spark, folder), "customer_id", "sales_month")


@register
def best_month(spark: SparkSession, folder: str) -> DataFrame:
    return op.best_period(
        _customer_months(spark, folder), "customer_id", "monthly_revenue", tie="sales_month"
    )


@register
def best_quarter(spark: SparkSession, folder: str) -> DataFrame:
    return op.best_period(
        revenue_by_quarter(spark, folder),
        "salesperson_id",
        "quarterly_revenue",
        tie=["sales_year", "sales_quarter"],
    )


@register
def yoy(spark: SparkSession, folder: str) -> DataFrame:
    return op.yoy(_seller_months(spark, folder), "salesperson_id")


# Running totals and ranks over one order


@register
def cumulative_revenue(spark: SparkSession, folder: str) -> DataFrame:
    sales = src.orders(spark, folder).select(
        F.col("order_date").alias("sale_date"), F.col("amount").alias("revenue")
    )
    return op.cumulative(sales, "sale_date", "revenue", out="cumulative_revenue")


@register
def cumulative_revenue_per_customer(spark: SparkSession, folder: str) -> DataFrame:
    sales = src.orders(spark, folder).select(
        "customer_id", F.col("order_date").alias("sale_date"), F.col("amount").alias("revenue")
    )
    return op.cumulative(
        sales, "sale_date", "revenue", "customer_id", out="customer_cumulative_revenue"
    )


@register
def cumulative_revenue_by_order(spark: SparkSession, folder: str) -> DataFrame:
    sales = src.orders(spark, folder).select("order_id", F.col("amount").alias("revenue"))
    return op.cumulative(sales, "order_id", "revenue", out="cumulative_revenue", unique=True)


@register
def department_running_total(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("dept", "emp_id", "salary")
    return op.cumulative(staff, "emp_id", "salary", "dept", out="running_total", unique=True)


@register
def compare_ranks(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "emp_name", "salary")
    return op.compare_ranks(
        staff, "salary", "emp_id", rank="salary_rank", dense_rank="salary_dense_rank"
    )


# Shares and averages


@register
def share_of_category(spark: SparkSession, folder: str) -> DataFrame:
    products = op.period_revenue(
        src.product_sales(spark, folder, dated=False),
        "product_id",
        grain=None,
        dim=src.dim_products(spark, folder),
        attrs="category",
        revenue="lifetime_revenue",
    )
    return op.share_of_group(
        products,
        "category",
        "lifetime_revenue",
        out="category_contribution_pct",
        total_out="category_revenue",
        average_out="category_avg_revenue",
    )


@register
def share_of_region(spark: SparkSession, folder: str) -> DataFrame:
    people = op.group_sum(
        _seller_months(spark, folder), "salesperson_id", "monthly_revenue", "salesperson_revenue"
    ).join(src.dim_salespersons(spark, folder).select("salesperson_id", "region"), "salesperson_id")
    return op.share_of_group(
        people,
        "region",
        "salesperson_revenue",
        out="regional_contribution_pct",
        total_out="regional_revenue",
    )


@register
def above_company_average(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "emp_name", "salary")
    return op.above_average(staff, "salary")


@register
def above_department_average(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "emp_name", "dept", "salary")
    return op.above_group_average(staff, "salary", "dept")


@register
def department_headcount_pct(spark: SparkSession, folder: str) -> DataFrame:
    return op.percent_of_total(
        src.employees(spark, folder), "dept", "employee_count", "employee_percentage"
    )


# Gaps, returns, cohorts


@register
def purchase_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return op.purchase_gaps(src.orders(spark, folder), "customer_id", "order_date")


@register
def inactivity_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return op.inactivity_gaps(src.orders(spark, folder), "customer_id", "order_date")


@register
def month_reactivations(spark: SparkSession, folder: str) -> DataFrame:
    months = active_months(spark, folder)
    return op.month_reactivations(months, "customer_id", "sales_month", extra=True)


@register
def month_reactivations_by_bits(spark: SparkSession, folder: str) -> DataFrame:
    return op.returns_of_bits(_bits(spark, folder), "customer_id", CALENDAR)


@register
def months_since_first(spark: SparkSession, folder: str) -> DataFrame:
    return op.with_cohort(active_months(spark, folder), "customer_id", "sales_month")


@register
def cohorts(spark: SparkSession, folder: str) -> DataFrame:
    return op.cohorts(
        _customer_months(spark, folder), "customer_id", "sales_month", "monthly_revenue"
    )


# Top-k and n-th highest


@register
def third_highest_salary(spark: SparkSession, folder: str) -> DataFrame:
    return op.nth_highest(src.employees(spark, folder), "salary", 3)


@register
def second_highest_salary(spark: SparkSession, folder: str) -> DataFrame:
    return op.nth_highest(
        src.employees(spark, folder), "salary", 2, out="second_highest_salary"
    )


@register
def rows_at_third_highest_salary(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "salary")
    return op.rows_at_nth_highest(staff, "salary", 3)


@register
def top_products_per_region_with_ties(spark: SparkSession, folder: str) -> DataFrame:
    products = op.group_sum(
        src.region_sales(spark, folder), ["region", "product"], "sales_amount", "revenue"
    )
    best = op.top_k_per_group(products, "region", "revenue", 2, method="dense_rank", few_ties=True)
    return best.drop("rnk")


@register
def top_salaries_per_department_rank(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "dept", "salary")
    return op.top_k_per_group(staff, "dept", "salary", 10, method="rank")


@register
def top_salaries_per_department(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "dept", "salary")
    return op.top_k_per_group(staff, "dept", "salary", 3, tie="emp_id")


@register
def top_orders(spark: SparkSession, folder: str) -> DataFrame:
    return op.top_k(src.orders(spark, folder), "amount", 5, tie="order_id")


@register
def peers_of_highest_paid(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "emp_name", "dept", "salary")
    return op.peers_of_max(staff, "dept", "salary").select("emp_id", "emp_name", "dept")


# Duplicates and set operations


@register
def duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return op.duplicates(src.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@register
def dedupe_keep_latest(spark: SparkSession, folder: str) -> DataFrame:
    lines = src.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        "l_partkey",
        "l_suppkey",
        F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
    )
    return op.dedupe_keep_latest(
        lines,
        ["l_orderkey", "l_linenumber"],
        "ship_date",
        tie=["l_partkey", "l_suppkey", "price"],
    )


@register
def dedupe_employees(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "dept", "dept_id", "join_date")
    return op.dedupe_keep_latest(staff, ["dept", "dept_id"], "join_date", tie="emp_id").drop(
        "dept_id"
    )


@register
def staff_union(spark: SparkSession, folder: str) -> DataFrame:
    return op.union_distinct(
        src.staff_of_year(spark, folder, 1999), src.staff_of_year(spark, folder, 2000)
    )


@register
def staff_union_all(spark: SparkSession, folder: str) -> DataFrame:
    return op.union_all(
        src.staff_of_year(spark, folder, 1999), src.staff_of_year(spark, folder, 2000)
    )


# Lookups


@register
def customers_with_orders(spark: SparkSession, folder: str) -> DataFrame:
    return op.matched(src.customers(spark, folder), src.orders(spark, folder), "customer_id")


@register
def customers_without_orders(spark: SparkSession, folder: str) -> DataFrame:
    return op.never_matched(
        src.customers(spark, folder), src.orders(spark, folder), "customer_id"
    )


@register
def customers_without_events(spark: SparkSession, folder: str) -> DataFrame:
    events = src.table(spark, folder, "events").select(F.col("user_id").alias("customer_id"))
    return op.never_matched(src.customers(spark, folder), events, "customer_id")


@register
def orders_without_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = src.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("order_id"))
    return op.never_matched(src.orders(spark, folder), lines, "order_id")


@register
def employees_with_manager(spark: SparkSession, folder: str) -> DataFrame:
    named = op.hierarchy_parent(
        src.employees(spark, folder), "emp_id", "manager_id", "emp_name", out="manager"
    )
    return named.select("emp_id", F.col("emp_name").alias("employee"), "manager")


@register
def employees_without_manager(spark: SparkSession, folder: str) -> DataFrame:
    return op.roots(src.employees(spark, folder), "manager_id").select("emp_id", "emp_name")


def _with_department(spark: SparkSession, folder: str, how: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "emp_name", "dept_id")
    joined = op.attach(staff, src.departments(spark, folder), "dept_id", how)
    return joined.select("emp_id", "emp_name", "dept_name")


@register
def inner_join_departments(spark: SparkSession, folder: str) -> DataFrame:
    return _with_department(spark, folder, "inner")


@register
def left_join_departments(spark: SparkSession, folder: str) -> DataFrame:
    return _with_department(spark, folder, "left")


@register
def full_join_departments(spark: SparkSession, folder: str) -> DataFrame:
    return _with_department(spark, folder, "full")


# Filters, functions, parameters, storage


@register
def salary_or_zero(spark: SparkSession, folder: str) -> DataFrame:
    return src.employees(spark, folder).select(
        "emp_id", "emp_name", or_zero("salary").cast("decimal(12,2)").alias("salary")
    )


@register
def annual_salaries(spark: SparkSession, folder: str) -> DataFrame:
    return src.employees(spark, folder).select(
        "emp_id", annual_salary("salary").alias("annual_salary")
    )


@register
def orders_in_year(spark: SparkSession, folder: str) -> DataFrame:
    return src.orders(spark, folder).filter(in_year("order_date", 2000))


@register
def employees_of_department(spark: SparkSession, folder: str) -> DataFrame:
    return op.by_key(src.employees(spark, folder), "dept_id", 10).select(
        "emp_id", "emp_name", "dept_id"
    )


@register
def employees_by_statement(spark: SparkSession, folder: str) -> DataFrame:
    return op.run_statement(
        spark,
        "SELECT emp_id, emp_name, dept_id FROM {staff} WHERE dept_id = :dept",
        {"staff": src.employees(spark, folder)},
        dept=10,
    )


@register
def balances_after_transfers(spark: SparkSession, folder: str) -> DataFrame:
    moves = op.transfers(
        src.transfer_requests(spark, folder), "payer_id", "payee_id", "amount"
    )
    return op.apply_adjustments(src.accounts(spark, folder), moves)


@register
def partitioned_sales(spark: SparkSession, folder: str) -> DataFrame:
    sales = src.orders(spark, folder).select(
        F.col("order_id").alias("sale_id"),
        F.col("order_date").alias("sale_date"),
        F.col("amount").alias("revenue"),
    )
    path = session_path(spark, "sales_by_month", of=folder)
    src.refresh_months(sales, "sale_date", path)
    return src.read_months(spark, path, "sale_date", "1999-11-15", "2000-02-11")


# Chains, set operators, statistics, data checks


@register
def management_levels(spark: SparkSession, folder: str) -> DataFrame:
    return op.hierarchy_levels(src.employees(spark, folder), "emp_id", "manager_id")


@register
def payroll_below_managers(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder)
    return op.hierarchy_totals(staff, "emp_id", "manager_id", "salary", "headcount", "payroll")


@register
def staff_of_both_years(spark: SparkSession, folder: str) -> DataFrame:
    return op.in_both(
        src.staff_of_year(spark, folder, 1999), src.staff_of_year(spark, folder, 2000)
    )


@register
def staff_of_first_year_only(spark: SparkSession, folder: str) -> DataFrame:
    return op.only_left(
        src.staff_of_year(spark, folder, 1999), src.staff_of_year(spark, folder, 2000)
    )


@register
def staff_of_both_years_with_copies(spark: SparkSession, folder: str) -> DataFrame:
    return op.in_both(
        src.staff_of_year(spark, folder, 1999),
        src.staff_of_year(spark, folder, 2000),
        keep_copies=True,
    )


@register
def staff_of_first_year_surplus(spark: SparkSession, folder: str) -> DataFrame:
    return op.only_left(
        src.staff_of_year(spark, folder, 1999),
        src.staff_of_year(spark, folder, 2000),
        keep_copies=True,
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six decimals: the last digits of a double depend on the order of summing."""
    return df.withColumns({c: F.round(F.col(c), 6).cast(MEAN) for c in columns})


@register
def salary_moments(spark: SparkSession, folder: str) -> DataFrame:
    stats = op.moments(src.employees(spark, folder), "dept", "salary")
    return _rounded(stats, "mean_value", "stddev_value")


@register
def salary_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    levels = {"lower_quartile": 0.25, "median_value": 0.5, "upper_quartile": 0.75}
    found = op.quantiles(src.employees(spark, folder), "dept", "salary", levels)
    return _rounded(found, *levels)


@register
def salary_quantiles_by_sketch(spark: SparkSession, folder: str) -> DataFrame:
    levels = {"lower_quartile": 0.25, "median_value": 0.5, "upper_quartile": 0.75}
    found = op.bracketed_quantiles(src.employees(spark, folder), "dept", "salary", levels)
    return _rounded(found, *levels)


@register
def commonest_quantity(spark: SparkSession, folder: str) -> DataFrame:
    return op.mode(src.table(spark, folder, "lineitem"), "l_returnflag", "l_quantity")


@register
def price_on_quantity(spark: SparkSession, folder: str) -> DataFrame:
    lines = src.table(spark, folder, "lineitem")
    found = op.correlation(lines, "l_returnflag", "l_extendedprice", "l_quantity")
    return _rounded(found, "correlation", "slope", "intercept")


@register
def order_amount_outliers(spark: SparkSession, folder: str) -> DataFrame:
    orders = src.orders(spark, folder).withColumn("sales_month", month_start("order_date"))
    return op.iqr_outliers(orders, "sales_month", "amount", reach=0.4).select(
        "order_id", "sales_month", "amount"
    )


@register
def order_amount_outliers_usual_reach(spark: SparkSession, folder: str) -> DataFrame:
    orders = src.orders(spark, folder).withColumn("sales_month", month_start("order_date"))
    return op.iqr_outliers(orders, "sales_month", "amount", reach=1.5).select(
        "order_id", "sales_month", "amount"
    )


@register
def event_value_outliers(spark: SparkSession, folder: str) -> DataFrame:
    events = src.table(spark, folder, "events").select("event_id", "event_type", "value")
    return op.iqr_outliers(events, "event_type", "value", reach=1.5)


@register
def salary_z_scores(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "dept", "salary")
    return _rounded(op.z_scores(staff, "dept", "salary"), "z_score")


@register
def missing_employee_values(spark: SparkSession, folder: str) -> DataFrame:
    return op.missing_values(
        src.employees(spark, folder), ["emp_name", "dept_id", "salary", "manager_id"]
    )


def _employee_rules() -> dict[str, Column]:
    return {
        "salary_not_positive": F.col("salary") > 0,
        "name_malformed": F.col("emp_name").startswith("Customer#"),
        "joined_too_late": F.col("join_date") < F.lit("1995-12-01").cast("date"),
    }


@register
def employee_rule_violations(spark: SparkSession, folder: str) -> DataFrame:
    return op.rule_violations(src.employees(spark, folder), _employee_rules())


@register
def employee_violations_while_writing(spark: SparkSession, folder: str) -> DataFrame:
    path = session_path(spark, "employees")
    counts = op.write_checked(src.employees(spark, folder), path, _employee_rules())
    rows = src.stored_rows(spark, path).agg(F.count("*").alias("row_count"))
    return rows.withColumns({name: F.lit(n).cast("bigint") for name, n in counts.items() if name != "row_count"})


@register
def sampled_orders(spark: SparkSession, folder: str) -> DataFrame:
    return op.keyed_sample(src.orders(spark, folder), "customer_id", 0.25)


@register
def stratified_orders(spark: SparkSession, folder: str) -> DataFrame:
    heads = src.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return op.stratified_sample(
        heads, "o_orderpriority", "o_orderkey", {"1-URGENT": 0.5, "2-HIGH": 0.25, "5-LOW": 0.125}
    )


@register
def orders_sampled_exactly(spark: SparkSession, folder: str) -> DataFrame:
    heads = src.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority")
    return op.exact_sample(heads, "o_orderpriority", "o_orderkey", 100)


@register
def orders_sampled_by_amount(spark: SparkSession, folder: str) -> DataFrame:
    heads = src.table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return op.exact_sample(heads, "o_orderpriority", "o_orderkey", 100, weight="o_totalprice").drop("o_totalprice")


@register
def revenue_by_segment_and_region(spark: SparkSession, folder: str) -> DataFrame:
    names = src.table(spark, folder, "region").select("r_name").distinct().orderBy("r_name")
    regions = [row["r_name"] for row in names.filter("r_name IS NOT NULL").collect()]
    sales = op.period_revenue(
        src.order_sales(spark, folder),
        grain=None,
        dim=src.dim_customers(spark, folder),
        attrs=["segment", "region"],
        revenue="revenue",
    )
    return op.pivot_sum(sales, "segment", "region", regions, "revenue", other="OTHER")


@register
def department_of_employee(spark: SparkSession, folder: str) -> DataFrame:
    staff = src.employees(spark, folder).select("emp_id", "dept_id")
    return op.lookup(
        staff, src.departments(spark, folder), "dept_id", "dept_name", "unknown"
    ).select("emp_id", "dept_name")


@register
def cohort_retention(spark: SparkSession, folder: str) -> DataFrame:
    return op.cohort_retention(active_months(spark, folder), "customer_id", "sales_month")


@register
def cohort_retention_by_bits(spark: SparkSession, folder: str) -> DataFrame:
    return op.retention_of_bits(_bits(spark, folder), CALENDAR)


@register
def churned_customers(spark: SparkSession, folder: str) -> DataFrame:
    return op.churned(
        src.orders(spark, folder), "customer_id", "order_date", FULL_YEARS_END, days=180
    )


@register
def customer_value_segments(spark: SparkSession, folder: str) -> DataFrame:
    lifetimes = op.period_revenue(
        src.order_sales(spark, folder), grain=None, revenue="lifetime_revenue"
    )
    return op.with_segment(
        lifetimes, "lifetime_revenue", {"high": 3_000_000, "middle": 1_500_000}, "low"
    )


@register
def view_to_purchase_conversion(spark: SparkSession, folder: str) -> DataFrame:
    events = src.table(spark, folder, "events")
    return op.conversion_rate(events, "user_id", "event_type", "view", "purchase")


@register
def reconciled_order_totals(spark: SparkSession, folder: str) -> DataFrame:
    heads = src.orders(spark, folder).groupBy("customer_id").agg(total("amount").alias("revenue"))
    lines = op.period_revenue(src.order_sales(spark, folder), grain=None, revenue="revenue")
    return op.reconcile(heads, lines, "customer_id", "revenue", "orders", "lines")


@register
def reconciled_order_totals_by_range(spark: SparkSession, folder: str) -> DataFrame:
    heads = src.orders(spark, folder).groupBy("customer_id").agg(total("amount").alias("revenue"))
    lines = op.period_revenue(src.order_sales(spark, folder), grain=None, revenue="revenue")
    return op.reconcile_by_range(heads, lines, "customer_id", "revenue", "orders", "lines")


@register
def monthly_totals_after_a_correction(spark: SparkSession, folder: str) -> DataFrame:
    """What a correction of some orders changed, found among all customers' months."""
    placed = src.orders(spark, folder).withColumn("sales_month", month_start("order_date"))
    corrected = placed.withColumn("amount", F.when(F.col("order_id") % 1009 == 0, F.col("amount") + 1).otherwise(F.col("amount")))
    sums = [f.groupBy("customer_id", "sales_month").agg(total("amount").alias("revenue")) for f in (placed, corrected)]
    return op.reconcile_by_range(*sums, ["customer_id", "sales_month"], "revenue", "before", "after")


# Reports


@register
def report_customer_monthly_performance(spark: SparkSession, folder: str) -> DataFrame:
    return plans.customer_monthly_performance(
        src.order_sales(spark, folder), src.dim_customers(spark, folder)
    )


@register
def report_customer_monthly_performance_two_rises(spark: SparkSession, folder: str) -> DataFrame:
    return plans.customer_monthly_performance(
        src.order_sales(spark, folder),
        src.dim_customers(spark, folder),
        min_streak=2,
        extra=True,
    )


@register
def report_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return plans.top_products(
        src.product_sales(spark, folder, dated=False), src.dim_products(spark, folder)
    )


@register
def report_attendance_streaks(spark: SparkSession, folder: str) -> DataFrame:
    return plans.attendance_streaks(
        src.attendance(spark, folder), src.dim_employees(spark, folder)
    )


@register
def report_customer_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    return plans.customer_lifecycle(
        src.order_sales(spark, folder), src.dim_customers(spark, folder)
    )


@register
def report_customer_lifecycle_two_rises(spark: SparkSession, folder: str) -> DataFrame:
    return plans.customer_lifecycle(
        src.order_sales(spark, folder), src.dim_customers(spark, folder), min_streak=2
    )


@register
def report_customer_lifecycle_activity(spark: SparkSession, folder: str) -> DataFrame:
    return plans.customer_lifecycle(
        src.order_sales(spark, folder), src.dim_customers(spark, folder), streak="activity"
    )


@register
def report_product_dominance(spark: SparkSession, folder: str) -> DataFrame:
    return plans.product_dominance(
        src.product_sales(spark, folder), src.dim_products(spark, folder)
    )


@register
def report_salesperson_performance(spark: SparkSession, folder: str) -> DataFrame:
    return plans.salesperson_performance(
        src.seller_sales(spark, folder), src.dim_salespersons(spark, folder)
    )


@register
def report_salesperson_performance_until_2001(spark: SparkSession, folder: str) -> DataFrame:
    return plans.salesperson_performance(
        src.seller_sales(spark, folder),
        src.dim_salespersons(spark, folder),
        as_of=FULL_YEARS_END,
    )


@register
def report_salesperson_performance_extra(spark: SparkSession, folder: str) -> DataFrame:
    return plans.salesperson_performance(
        src.seller_sales(spark, folder),
        src.dim_salespersons(spark, folder),
        as_of=FULL_YEARS_END,
        extra=True,
    )


@register
def report_customer_cohorts(spark: SparkSession, folder: str) -> DataFrame:
    return plans.customer_cohorts(
        src.order_sales(spark, folder), src.dim_customers(spark, folder), extra=True
    )


@register
def report_customer_retention(spark: SparkSession, folder: str) -> DataFrame:
    return plans.customer_retention(
        src.order_sales(spark, folder), src.dim_customers(spark, folder), extra=True
    )


@register
def report_category_performance(spark: SparkSession, folder: str) -> DataFrame:
    return plans.category_performance(
        src.product_sales(spark, folder), src.dim_products(spark, folder)
    )


@register
def report_category_performance_18(spark: SparkSession, folder: str) -> DataFrame:
    return plans.category_performance(
        src.product_sales(spark, folder),
        src.dim_products(spark, folder),
        min_share=18,
    )


@register
def report_regional_performance(spark: SparkSession, folder: str) -> DataFrame:
    return plans.regional_performance(
        src.seller_sales(spark, folder), src.dim_salespersons(spark, folder)
    )


@register
def report_regional_performance_until_2001(spark: SparkSession, folder: str) -> DataFrame:
    return plans.regional_performance(
        src.seller_sales(spark, folder),
        src.dim_salespersons(spark, folder),
        as_of=FULL_YEARS_END,
    )


@register
def report_regional_performance_extra(spark: SparkSession, folder: str) -> DataFrame:
    return plans.regional_performance(
        src.seller_sales(spark, folder),
        src.dim_salespersons(spark, folder),
        as_of=FULL_YEARS_END,
        extra=True,
    )
