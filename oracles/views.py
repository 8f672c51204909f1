"""WITH clauses that rebuild the business views from the raw tables."""

from __future__ import annotations

VIEWS = {
    "sales": """sales AS (
        SELECT o_custkey AS customer_id,
               p_brand || '|' || p_type AS product_id,
               s_nationkey AS salesperson_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS sales_amount
        FROM lineitem, orders, part, supplier
        WHERE l_orderkey = o_orderkey AND l_partkey = p_partkey AND l_suppkey = s_suppkey)""",
    "buyers": """buyers AS (
        SELECT c_custkey AS customer_id, c_name AS customer_name,
               c_mktsegment AS segment, r_name AS region
        FROM customer, nation, region
        WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey)""",
    "goods": """goods AS (
        SELECT DISTINCT p_brand || '|' || p_type AS product_id,
               p_brand || '|' || p_type AS product_name, p_brand AS category
        FROM part)""",
    "sellers": """sellers AS (
        SELECT n_nationkey AS salesperson_id, n_name AS salesperson_name, r_name AS region
        FROM nation, region WHERE n_regionkey = r_regionkey)""",
    "present": """present AS (
        SELECT DISTINCT user_id AS employee_id, CAST(ts AS DATE) AS attendance_date
        FROM events WHERE event_type = 'view')""",
    "staff": """staff AS (
        SELECT c_custkey AS emp_id, c_name AS emp_name,
               c_nationkey AS dept_id,
               c_mktsegment AS dept,
               CASE WHEN c_custkey <> 0 THEN c_custkey // 10 END AS manager_id,
               CAST(c_acctbal AS DECIMAL(12,2)) AS salary,
               CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) AS DATE) AS join_date
        FROM customer)""",
    "units": """units AS (
        SELECT n_nationkey AS dept_id, n_name AS dept_name FROM nation)""",
    "placed": """placed AS (
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               CAST(o_orderdate AS DATE) AS order_date,
               CAST(o_totalprice AS DECIMAL(18,2)) AS amount
        FROM orders)""",
    "shop": """shop AS (
        SELECT r_name AS region, p_type AS product,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS sales_amount
        FROM lineitem, supplier, nation, region, part
        WHERE l_suppkey = s_suppkey AND s_nationkey = n_nationkey
          AND n_regionkey = r_regionkey AND l_partkey = p_partkey)""",
    "by_month": """by_month AS (
        SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS m,
               CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS v
        FROM sales GROUP BY ALL)""",
    "goods_by_month": """goods_by_month AS (
        SELECT product_id, CAST(date_trunc('month', order_date) AS DATE) AS m,
               CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS v
        FROM sales GROUP BY ALL)""",
}

NEEDS = {"by_month": ["sales"], "goods_by_month": ["sales"]}


def with_views(*names: str) -> str:
    """``WITH`` clause that defines the named views and what they read."""
    ordered: list[str] = []
    for name in names:
        for needed in [*NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    return "WITH " + ",\n".join(VIEWS[n] for n in ordered)


def pct(part: str, whole: str) -> str:
    """Percentage with two decimals, NULL when the whole is zero."""
    ratio = f"CAST(({part}) AS DOUBLE) * 100 / NULLIF(CAST(({whole}) AS DOUBLE), 0)"
    return f"CAST(ROUND(CAST({ratio} AS DECIMAL(38,10)), 2) AS DECIMAL(18,2))"


def avg6(total: str, count: str) -> str:
    """Average of a money total with six decimals."""
    return f"CAST(CAST({total} AS DOUBLE) / ({count}) AS DECIMAL(28,6))"


def avg2(total: str, count: str) -> str:
    """Average of a positive money total with two decimals, half up, in whole cents."""
    cents = f"CAST(CAST(({total}) AS DECIMAL(28,2)) * 100 AS HUGEINT)"
    rounded = f"((2 * {cents} + ({count})) // (2 * ({count})))"
    return f"CAST(CAST({rounded} AS DECIMAL(30,0)) * 0.01 AS DECIMAL(18,2))"
