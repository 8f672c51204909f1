"""SQL statements of the chains, statistics and data checks."""

from __future__ import annotations

from oracles.views import pct, with_views


def _six(value: str) -> str:
    return f"CAST(ROUND({value}, 6) AS DECIMAL(28,6))"


_STAFF_1999 = """SELECT c_name AS employee_name FROM placed JOIN customer
    ON c_custkey = customer_id WHERE year(order_date) = 1999"""
_STAFF_2000 = _STAFF_1999.replace("1999", "2000")

TOPICS = {
    "management_levels": "WITH RECURSIVE" + with_views("staff").removeprefix("WITH") + """,
        climb AS (
            SELECT emp_id, emp_id AS top, manager_id AS next, CAST(0 AS BIGINT) AS level
            FROM staff
            UNION ALL
            SELECT c.emp_id, s.emp_id, s.manager_id, c.level + 1
            FROM climb c JOIN staff s ON s.emp_id = c.next)
        SELECT emp_id, top, level FROM climb WHERE next IS NULL""",
    "staff_of_both_years": with_views("placed") + f"{_STAFF_1999} INTERSECT {_STAFF_2000}",
    "staff_of_first_year_only": with_views("placed") + f"{_STAFF_1999} EXCEPT {_STAFF_2000}",
    "staff_of_both_years_with_copies": with_views("placed")
    + f"{_STAFF_1999} INTERSECT ALL {_STAFF_2000}",
    "staff_of_first_year_surplus": with_views("placed")
    + f"{_STAFF_1999} EXCEPT ALL {_STAFF_2000}",
    "salary_moments": with_views("staff") + f"""
        SELECT dept, COUNT(salary) AS value_count,
               {_six('AVG(CAST(salary AS DOUBLE))')} AS mean_value,
               {_six('stddev_samp(CAST(salary AS DOUBLE))')} AS stddev_value
        FROM staff GROUP BY dept""",
    "salary_quantiles": with_views("staff") + f"""
        SELECT dept,
               {_six('quantile_cont(CAST(salary AS DOUBLE), 0.25)')} AS lower_quartile,
               {_six('median(CAST(salary AS DOUBLE))')} AS median_value,
               {_six('quantile_cont(CAST(salary AS DOUBLE), 0.75)')} AS upper_quartile
        FROM staff GROUP BY dept""",
    "commonest_quantity": """
        SELECT l_returnflag, MIN(l_quantity) AS l_quantity, n AS occurrences
        FROM (SELECT l_returnflag, l_quantity, COUNT(*) AS n FROM lineitem GROUP BY ALL)
        NATURAL JOIN (
            SELECT l_returnflag, MAX(n) AS n FROM (
                SELECT l_returnflag, COUNT(*) AS n FROM lineitem
                GROUP BY l_returnflag, l_quantity)
            GROUP BY l_returnflag)
        GROUP BY l_returnflag, n""",
    "price_on_quantity": f"""
        SELECT l_returnflag,
               {_six('corr(l_extendedprice, l_quantity)')} AS correlation,
               {_six('regr_slope(l_extendedprice, l_quantity)')} AS slope,
               {_six('regr_intercept(l_extendedprice, l_quantity)')} AS intercept
        FROM lineitem GROUP BY l_returnflag""",
    "order_amount_outliers": with_views("placed") + """,
        m AS (SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS sales_month FROM placed),
        q AS (SELECT sales_month, quantile_cont(CAST(amount AS DOUBLE), 0.25) AS q1,
                     quantile_cont(CAST(amount AS DOUBLE), 0.75) AS q3
              FROM m GROUP BY sales_month)
        SELECT order_id, sales_month, amount FROM m NATURAL JOIN q
        WHERE NOT CAST(amount AS DOUBLE) BETWEEN q1 - (q3 - q1) * CAST(0.4 AS DOUBLE)
                                             AND q3 + (q3 - q1) * CAST(0.4 AS DOUBLE)""",
    "order_amount_outliers_usual_reach": with_views("placed") + """,
        m AS (SELECT *, CAST(date_trunc('month', order_date) AS DATE) AS sales_month FROM placed),
        q AS (SELECT sales_month, quantile_cont(CAST(amount AS DOUBLE), 0.25) AS q1,
                     quantile_cont(CAST(amount AS DOUBLE), 0.75) AS q3
              FROM m GROUP BY sales_month)
        SELECT order_id, sales_month, amount FROM m NATURAL JOIN q
        WHERE NOT CAST(amount AS DOUBLE) BETWEEN q1 - (q3 - q1) * CAST(1.5 AS DOUBLE)
                                             AND q3 + (q3 - q1) * CAST(1.5 AS DOUBLE)""",
    "event_value_outliers": """
        SELECT event_id, event_type, value FROM events NATURAL JOIN (
            SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
            FROM events GROUP BY event_type)
        WHERE value < q1 - (q3 - q1) * CAST(1.5 AS DOUBLE)
           OR value > q3 + (q3 - q1) * CAST(1.5 AS DOUBLE)""",
    "salary_z_scores": with_views("staff") + f"""
        SELECT emp_id, dept, salary,
               {_six("(CAST(salary AS DOUBLE) - AVG(CAST(salary AS DOUBLE)) OVER w) "
                     "/ stddev_samp(CAST(salary AS DOUBLE)) OVER w")} AS z_score
        FROM staff WINDOW w AS (PARTITION BY dept)""",
    "missing_employee_values": with_views("staff") + """
        SELECT COUNT(*) AS row_count, COUNT(*) - COUNT(emp_name) AS emp_name_missing,
               COUNT(*) - COUNT(dept_id) AS dept_id_missing,
               COUNT(*) - COUNT(salary) AS salary_missing,
               COUNT(*) - COUNT(manager_id) AS manager_id_missing
        FROM staff""",
    "employee_rule_violations": with_views("staff") + """
        SELECT COUNT(*) FILTER (WHERE salary IS NULL OR salary <= 0) AS salary_not_positive,
               COUNT(*) FILTER (WHERE emp_name NOT LIKE 'Customer#%') AS name_malformed,
               COUNT(*) FILTER (WHERE join_date >= DATE '1995-12-01') AS joined_too_late
        FROM staff""",
    "sampled_orders": with_views("placed") + """
        SELECT * FROM placed
        WHERE substr(md5(CAST(customer_id AS VARCHAR)), 1, 8) < '40000000'""",
    "stratified_orders": """
        SELECT o_orderkey, o_orderpriority FROM orders
        WHERE substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)
              < CASE o_orderpriority WHEN '1-URGENT' THEN '80000000' WHEN '2-HIGH' THEN '40000000'
                                     WHEN '5-LOW' THEN '20000000' ELSE '' END""",
    "revenue_by_segment_and_region": with_views("sales", "buyers") + """
        SELECT segment,
               CAST(SUM(sales_amount) FILTER (WHERE region = 'AFRICA') AS DECIMAL(28,2))
                   AS "AFRICA",
               CAST(SUM(sales_amount) FILTER (WHERE region = 'AMERICA') AS DECIMAL(28,2))
                   AS "AMERICA",
               CAST(SUM(sales_amount) FILTER (WHERE region = 'ASIA') AS DECIMAL(28,2))
                   AS "ASIA",
               CAST(SUM(sales_amount) FILTER (WHERE region = 'EUROPE') AS DECIMAL(28,2))
                   AS "EUROPE",
               CAST(SUM(sales_amount) FILTER (WHERE region = 'MIDDLE EAST') AS DECIMAL(28,2))
                   AS "MIDDLE EAST",
               CAST(SUM(sales_amount) FILTER (WHERE region NOT IN
                   ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')) AS DECIMAL(28,2))
                   AS "OTHER"
        FROM sales NATURAL JOIN buyers GROUP BY segment""",
    "department_of_employee": with_views("staff", "units") + """
        SELECT emp_id, IFNULL((SELECT dept_name FROM units u WHERE u.dept_id = s.dept_id),
                              'unknown') AS dept_name
        FROM staff s""",
    "cohort_retention": with_views("by_month") + f""",
        f AS (SELECT customer_id, MIN(m) AS cohort_month FROM by_month GROUP BY customer_id),
        n AS (SELECT cohort_month, COUNT(*) AS cohort_size FROM f GROUP BY cohort_month)
        SELECT cohort_month,
               CAST(date_diff('month', cohort_month, m) AS INTEGER) AS months_since_first,
               COUNT(*) AS active_entities, cohort_size,
               {pct('COUNT(*)', 'cohort_size')} AS retention_pct
        FROM by_month NATURAL JOIN f NATURAL JOIN n
        GROUP BY cohort_month, m, cohort_size""",
    "churned_customers": with_views("placed") + """
        SELECT customer_id, MAX(order_date) AS last_activity,
               CAST(DATE '2001-01-01' - MAX(order_date) AS INTEGER) AS idle_days
        FROM placed WHERE order_date < DATE '2001-01-01'
        GROUP BY customer_id HAVING MAX(order_date) <= DATE '2001-01-01' - 180""",
    "customer_value_segments": with_views("sales") + """
        SELECT customer_id, CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS lifetime_revenue,
               CASE WHEN SUM(sales_amount) < 1500000 THEN 'low'
                    WHEN SUM(sales_amount) < 3000000 THEN 'middle' ELSE 'high' END AS segment
        FROM sales GROUP BY customer_id""",
    "view_to_purchase_conversion": f"""
        WITH v AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'view')
        SELECT COUNT(*) AS started, COUNT(p.user_id) AS converted,
               {pct('COUNT(p.user_id)', 'COUNT(*)')} AS conversion_pct
        FROM v LEFT JOIN (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase') p
             USING (user_id)""",
    "reconciled_order_totals": with_views("sales", "placed") + """,
        a AS (SELECT customer_id, CAST(SUM(amount) AS DECIMAL(28,2)) AS orders_revenue
              FROM placed GROUP BY customer_id),
        b AS (SELECT customer_id, CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS lines_revenue
              FROM sales GROUP BY customer_id)
        SELECT customer_id, orders_revenue, lines_revenue,
               CAST(IFNULL(orders_revenue, 0) - IFNULL(lines_revenue, 0) AS DECIMAL(29,2))
                   AS difference,
               CASE WHEN orders_revenue IS NULL THEN 'only_lines'
                    WHEN lines_revenue IS NULL THEN 'only_orders'
                    ELSE 'different' END AS status
        FROM a FULL JOIN b USING (customer_id)
        WHERE orders_revenue IS DISTINCT FROM lines_revenue""",
    "employee_violations_while_writing": with_views("staff") + """
        SELECT COUNT(*) AS row_count,
               COUNT(*) FILTER (WHERE salary IS NULL OR salary <= 0) AS salary_not_positive,
               COUNT(*) FILTER (WHERE emp_name NOT LIKE 'Customer#%') AS name_malformed,
               COUNT(*) FILTER (WHERE join_date >= DATE '1995-12-01') AS joined_too_late
        FROM staff""",
    "orders_sampled_exactly": """
        SELECT o_orderkey, o_orderpriority FROM orders
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY o_orderpriority
            ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8), o_orderkey) <= 100""",
    "orders_sampled_by_amount": """
        SELECT o_orderkey, o_orderpriority FROM orders WHERE o_totalprice > 0
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY o_orderpriority
            ORDER BY ln((CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT)
                         + CAST(0.5 AS DOUBLE)) / 4294967296) / o_totalprice DESC, o_orderkey) <= 100""",
    "monthly_totals_after_a_correction": with_views("placed") + """,
        m AS (
            SELECT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS sales_month,
                   CAST(SUM(amount) AS DECIMAL(28,2)) AS before_revenue,
                   CAST(SUM(amount) + COUNT(amount) FILTER (WHERE order_id % 1009 = 0)
                        AS DECIMAL(28,2)) AS after_revenue
            FROM placed GROUP BY ALL)
        SELECT *, CAST(before_revenue - after_revenue AS DECIMAL(29,2)) AS difference,
               'different' AS status
        FROM m WHERE before_revenue <> after_revenue""",
}

TOPICS["payroll_below_managers"] = "WITH RECURSIVE" + with_views("staff").removeprefix("WITH") + """,
        climb AS (
            SELECT emp_id AS top, emp_id, salary, manager_id AS next FROM staff
            UNION ALL
            SELECT s.emp_id, c.emp_id, c.salary, s.manager_id
            FROM climb c JOIN staff s ON s.emp_id = c.next)
        SELECT top AS emp_id, COUNT(*) AS headcount,
               CAST(COALESCE(SUM(salary), 0) AS DECIMAL(28,2)) AS payroll
        FROM climb GROUP BY top"""

# The same results by another way.
TOPICS["salary_quantiles_by_sketch"] = TOPICS["salary_quantiles"]
TOPICS["cohort_retention_by_bits"] = TOPICS["cohort_retention"]
TOPICS["reconciled_order_totals_by_range"] = TOPICS["reconciled_order_totals"]
