"""Business views over the generated retail tables.

Amounts are stored as doubles; each view turns them into decimals at the scan.
Views of sales fold the lines before they attach anything to them.  They rest on
two rules of the source: every line has an order, a part and a supplier, and a
key names one row of its table.  Lines that break the first drop out where the
missing table is read, as in an inner join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainline.functions import TOTAL, exact, in_year, money, month_start, total
from grainline.sources.tables import table


def order_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales fact at order grain: customer_id, order_date, sales_amount.

    Lines are summed per order on the map side before the join, which moves a
    row per order instead of a row per line.
    """
    lines = table(spark, folder, "lineitem")
    amounts = lines.groupBy("l_orderkey").agg(total(money("l_extendedprice")).alias("sales_amount"))
    heads = table(spark, folder, "orders")
    return heads.join(amounts, F.col("o_orderkey") == F.col("l_orderkey")).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        "sales_amount",
    )


def sold_orders(spark: SparkSession, folder: str) -> DataFrame:
    """customer_id and order_date of the orders that have a line."""
    lines = table(spark, folder, "lineitem").select("l_orderkey")
    heads = table(spark, folder, "orders")
    return heads.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )


def _dated_lines(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """A line key, the day of its order and the amount: the one shuffle of lines."""
    heads = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.col("o_orderdate").cast("date").alias("order_date"),
    )
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", key, money("l_extendedprice").alias("sales_amount")
    )
    return lines.join(heads, "l_orderkey").drop("l_orderkey")


def product_sales(spark: SparkSession, folder: str, dated: bool = True) -> DataFrame:
    """Sales fact of the products: product_id, order_date, sales_amount.

    One row for each part and month, dated at the month's first day; without
    ``dated`` one for each part, and orders are not read.
    """
    key = "l_partkey"
    if dated:
        lines = _dated_lines(spark, folder, key)
        folded = lines.groupBy(key, month_start("order_date").alias("order_date"))
    else:
        lines = table(spark, folder, "lineitem").select(
            key, money("l_extendedprice").alias("sales_amount")
        )
        folded = lines.groupBy(key)
    parts = table(spark, folder, "part").select("p_partkey", _product_key().alias("product_id"))
    sums = folded.agg(total("sales_amount").alias("sales_amount"))
    dates = ["order_date"] if dated else []
    return sums.join(parts, F.col(key) == F.col("p_partkey")).select(
        "product_id", *dates, "sales_amount"
    )


def seller_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales fact of the salespeople: salesperson_id, order_date, sales_amount.

    One row for each supplier and day.
    """
    sums = (
        _dated_lines(spark, folder, "l_suppkey")
        .groupBy("l_suppkey", "order_date")
        .agg(total("sales_amount").alias("sales_amount"))
    )
    sellers = table(spark, folder, "supplier")
    return sums.join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("s_nationkey").alias("salesperson_id"), "order_date", "sales_amount"
    )


def _product_key():
    return F.concat("p_brand", F.lit("|"), "p_type")


def _nations(spark: SparkSession, folder: str) -> DataFrame:
    nations = table(spark, folder, "nation")
    regions = table(spark, folder, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))


def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "customer")
    placed = people.join(_nations(spark, folder), F.col("c_nationkey") == F.col("n_nationkey"))
    return placed.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("r_name").alias("region"),
    )


def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    kinds = table(spark, folder, "part").select("p_brand", "p_type").distinct()
    return kinds.select(
        _product_key().alias("product_id"),
        _product_key().alias("product_name"),
        F.col("p_brand").alias("category"),
    )


def dim_salespersons(spark: SparkSession, folder: str) -> DataFrame:
    return _nations(spark, folder).select(
        F.col("n_nationkey").alias("salesperson_id"),
        F.col("n_name").alias("salesperson_name"),
        F.col("r_name").alias("region"),
    )


def attendance(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    status = F.when(F.col("event_type") == "view", "Present").otherwise("Absent")
    return events.select(
        F.col("user_id").alias("employee_id"),
        F.col("ts").cast("date").alias("attendance_date"),
        status.alias("attendance_status"),
    )


def dim_employees(spark: SparkSession, folder: str) -> DataFrame:
    people = table(spark, folder, "events").select("user_id").distinct()
    return people.select(
        F.col("user_id").alias("employee_id"),
        F.concat(F.lit("employee-"), F.col("user_id").cast("string")).alias("employee_name"),
        (F.col("user_id") % 5).cast("string").alias("department"),
    )


def employees(spark: SparkSession, folder: str) -> DataFrame:
    """Employees with department, salary and manager; the first has no manager."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("emp_id"),
        F.col("c_name").alias("emp_name"),
        F.col("c_nationkey").alias("dept_id"),
        F.col("c_mktsegment").alias("dept"),
        F.when(key == 0, None).otherwise(F.expr("c_custkey div 10")).alias("manager_id"),
        exact("c_acctbal", "decimal(12,2)").alias("salary"),
        F.date_add(F.lit("1995-01-01").cast("date"), (key % 365).cast("int")).alias("join_date"),
    )


def departments(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("dept_id"), F.col("n_name").alias("dept_name")
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name")
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        money("o_totalprice").alias("amount"),
    )


def region_sales(spark: SparkSession, folder: str) -> DataFrame:
    """Sales by region of the seller and type of the part.

    Sellers have few regions, so lines are folded to one row for each region and
    part; a pair of seller and part is near unique.  The part's type is joined to
    those rows.
    """
    lines = table(spark, folder, "lineitem")
    sellers = table(spark, folder, "supplier")
    sums = (
        lines.join(sellers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(_nations(spark, folder), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("r_name").alias("region"), "l_partkey")
        .agg(total(money("l_extendedprice")).alias("sales_amount"))
    )
    parts = table(spark, folder, "part")
    return sums.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        "region", F.col("p_type").alias("product"), "sales_amount"
    )


def staff_of_year(spark: SparkSession, folder: str, year: int) -> DataFrame:
    """Names of the customers with an order in a year, one row per order."""
    placed = orders(spark, folder).filter(in_year("order_date", year))
    return placed.join(customers(spark, folder), "customer_id").select(
        F.col("customer_name").alias("employee_name")
    )


def accounts(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("account_id"),
        exact("c_acctbal", TOTAL).alias("balance"),
    )


def transfer_requests(spark: SparkSession, folder: str) -> DataFrame:
    """One transfer per order: its customer pays the next customer number."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("payer_id"),
        (F.col("o_custkey") - F.col("o_custkey") % 2 * 2 + 1).alias("payee_id"),
        money("o_totalprice").alias("amount"),
    )
