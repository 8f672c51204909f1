"""One SQL statement per registered query, written from its definition."""

from __future__ import annotations

from oracles.reports import REPORTS
from oracles.topics import TOPICS
from oracles.views import avg2, avg6, pct, with_views

# Start of the growth run a month belongs to: the last month at which the value
# did not rise against the month right before it.
_GROWTH_RUNS = """
    stepped AS (
        SELECT *, NOT COALESCE(v > LAG(v) OVER w
                   AND date_diff('month', LAG(m) OVER w, m) = 1, FALSE) AS starts
        FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY m)),
    runs AS (
        SELECT *, last_value(CASE WHEN starts THEN m END IGNORE NULLS) OVER (
                   PARTITION BY {key} ORDER BY m) AS run_start
        FROM stepped)"""

OPERATORS = {
    "period_revenue": with_views("by_month", "buyers") + """
        SELECT customer_id, segment, region, m AS sales_month, v AS monthly_revenue
        FROM by_month NATURAL JOIN buyers""",
    "period_revenue_total": with_views("sales", "goods") + """
        SELECT product_id, category, CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS total_revenue
        FROM sales NATURAL JOIN goods GROUP BY ALL""",
    "active_months": with_views("sales") + """
        SELECT DISTINCT customer_id, CAST(date_trunc('month', order_date) AS DATE) AS sales_month
        FROM sales""",
    "revenue_by_year": with_views("sales") + """
        SELECT salesperson_id, CAST(year(order_date) AS INTEGER) AS sales_year,
               CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS yearly_revenue
        FROM sales GROUP BY ALL""",
    "revenue_by_quarter": with_views("sales") + """
        SELECT salesperson_id, CAST(year(order_date) AS INTEGER) AS sales_year,
               CAST(quarter(order_date) AS INTEGER) AS sales_quarter,
               CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS quarterly_revenue
        FROM sales GROUP BY ALL""",
    "sales_summary": with_views("placed") + f"""
        SELECT COUNT(*) AS order_count, CAST(SUM(amount) AS DECIMAL(28,2)) AS total_amount,
               {avg6('SUM(amount)', 'COUNT(*)')} AS average_amount,
               MAX(amount) AS highest_amount, MIN(order_date) AS first_day
        FROM placed""",
    "average_lifetime": with_views("sales") + f"""
        SELECT {avg6('SUM(sales_amount)', 'COUNT(DISTINCT customer_id)')} AS avg_revenue
        FROM sales""",
    "monthly_growth": with_views("by_month") + f"""
        SELECT n.customer_id, n.m AS sales_month, n.v AS monthly_revenue,
               p.m AS previous_sales_month, p.v AS previous_monthly_revenue,
               {pct('n.v - p.v', 'p.v')} AS mom_growth,
               CAST(COALESCE(n.v > p.v AND p.m + INTERVAL 1 MONTH = n.m, FALSE) AS INTEGER)
                   AS growth_flag
        FROM by_month n ASOF LEFT JOIN by_month p
          ON n.customer_id = p.customer_id AND n.m > p.m""",
    "growth_streaks": with_views("goods_by_month") + ","
    + _GROWTH_RUNS.format(source="goods_by_month", key="product_id") + """
        SELECT product_id, run_start, MAX(m) AS run_end, COUNT(*) - 1 AS streak_length
        FROM runs GROUP BY product_id, run_start HAVING COUNT(*) > 1""",
    "longest_growth_streak": with_views("by_month") + ","
    + _GROWTH_RUNS.format(source="by_month", key="customer_id") + """
        SELECT customer_id, MAX(n) AS longest_streak
        FROM (SELECT customer_id, COUNT(*) - 1 AS n FROM runs GROUP BY customer_id, run_start)
        WHERE n > 0 GROUP BY customer_id""",
    "activity_streaks_by_month": with_views("by_month") + """
        SELECT customer_id, MIN(m) AS run_start, MAX(m) AS run_end, COUNT(*) AS streak_length
        FROM (SELECT customer_id, m, year(m) * 12 + month(m)
                     - ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY m) AS island
              FROM by_month)
        GROUP BY customer_id, island""",
    "activity_streaks_by_day": with_views("present") + """
        SELECT employee_id, MIN(attendance_date) AS run_start, MAX(attendance_date) AS run_end,
               COUNT(*) AS streak_length
        FROM (SELECT *, attendance_date - CAST(ROW_NUMBER() OVER (
                     PARTITION BY employee_id ORDER BY attendance_date) AS INTEGER) AS island
              FROM present)
        GROUP BY employee_id, island""",
    "rolling_average": with_views("by_month") + f"""
        SELECT customer_id, m AS sales_month, v AS monthly_revenue,
               {avg2('SUM(v) OVER w', 'COUNT(*) OVER w')} AS rolling_avg_3m
        FROM by_month
        WINDOW w AS (PARTITION BY customer_id ORDER BY m ROWS 2 PRECEDING)""",
    "rolling_sum": with_views("goods_by_month") + """
        SELECT product_id, m AS sales_month, v AS monthly_revenue,
               CAST(SUM(v) OVER (PARTITION BY product_id ORDER BY m ROWS 2 PRECEDING)
                    AS DECIMAL(28,2)) AS rolling_sum_3m
        FROM goods_by_month""",
    "cumulative_revenue": with_views("placed") + """
        SELECT order_date AS sale_date, amount AS revenue,
               CAST(SUM(amount) OVER (ORDER BY order_date) AS DECIMAL(28,2))
                   AS cumulative_revenue
        FROM placed""",
    "cumulative_revenue_per_customer": with_views("placed") + """
        SELECT customer_id, order_date AS sale_date, amount AS revenue,
               CAST(SUM(amount) OVER (PARTITION BY customer_id ORDER BY order_date)
                    AS DECIMAL(28,2)) AS customer_cumulative_revenue
        FROM placed""",
    "cumulative_revenue_by_order": with_views("placed") + """
        SELECT order_id, amount AS revenue,
               CAST(SUM(amount) OVER (ORDER BY order_id) AS DECIMAL(28,2)) AS cumulative_revenue
        FROM placed""",
    "department_running_total": with_views("staff") + """
        SELECT dept, emp_id, salary,
               CAST(SUM(salary) OVER (PARTITION BY dept ORDER BY emp_id) AS DECIMAL(28,2))
                   AS running_total
        FROM staff""",
    "latest_month": with_views("by_month") + """
        SELECT customer_id, MAX(m) AS sales_month, arg_max(v, m) AS monthly_revenue
        FROM by_month GROUP BY customer_id""",
    "best_month": with_views("by_month") + """
        SELECT customer_id, MIN(m) AS sales_month, v AS monthly_revenue
        FROM by_month NATURAL JOIN
             (SELECT customer_id, MAX(v) AS v FROM by_month GROUP BY customer_id)
        GROUP BY customer_id, v""",
    "best_quarter": with_views("sales") + """,
        q AS (SELECT salesperson_id, CAST(year(order_date) AS INTEGER) AS sales_year,
                     CAST(quarter(order_date) AS INTEGER) AS sales_quarter,
                     CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS quarterly_revenue
              FROM sales GROUP BY ALL)
        SELECT DISTINCT ON (salesperson_id) salesperson_id, sales_year, sales_quarter,
               quarterly_revenue
        FROM q
        ORDER BY salesperson_id, quarterly_revenue DESC, sales_year, sales_quarter""",
    "share_of_category": with_views("sales", "goods") + f""",
        p AS (SELECT product_id, category,
                     CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS lifetime_revenue
              FROM sales NATURAL JOIN goods GROUP BY ALL),
        c AS (SELECT category, CAST(SUM(lifetime_revenue) AS DECIMAL(28,2)) AS category_revenue,
                     {avg6('SUM(lifetime_revenue)', 'COUNT(*)')} AS category_avg_revenue
              FROM p GROUP BY category)
        SELECT product_id, category, lifetime_revenue, category_revenue, category_avg_revenue,
               {pct('lifetime_revenue', 'category_revenue')} AS category_contribution_pct
        FROM p NATURAL JOIN c""",
    "share_of_region": with_views("sales", "sellers") + f""",
        s AS (SELECT salesperson_id, region,
                     CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS salesperson_revenue
              FROM sales NATURAL JOIN sellers GROUP BY ALL),
        r AS (SELECT region, CAST(SUM(salesperson_revenue) AS DECIMAL(28,2)) AS regional_revenue
              FROM s GROUP BY region)
        SELECT salesperson_id, region, salesperson_revenue, regional_revenue,
               {pct('salesperson_revenue', 'regional_revenue')} AS regional_contribution_pct
        FROM s NATURAL JOIN r""",
    "above_company_average": with_views("staff") + """
        SELECT emp_id, emp_name, salary FROM staff
        WHERE salary * (SELECT COUNT(salary) FROM staff) > (SELECT SUM(salary) FROM staff)""",
    "above_department_average": with_views("staff") + """
        SELECT emp_id, emp_name, dept, salary FROM staff
        QUALIFY salary * COUNT(salary) OVER (PARTITION BY dept)
                > SUM(salary) OVER (PARTITION BY dept)""",
    "purchase_gaps": with_views("placed") + """
        SELECT customer_id, order_date, LAG(order_date) OVER w AS previous_order_date,
               CAST(order_date - LAG(order_date) OVER w AS INTEGER) AS inactive_days
        FROM (SELECT DISTINCT customer_id, order_date FROM placed)
        WINDOW w AS (PARTITION BY customer_id ORDER BY order_date)""",
    "inactivity_gaps": with_views("placed") + """
        SELECT customer_id, CAST(MAX(g) AS INTEGER) AS max_inactive_days,
               COUNT(*) AS reactivation_count
        FROM (SELECT n.customer_id, MIN(n.order_date - p.order_date) AS g
              FROM placed n JOIN placed p
                ON n.customer_id = p.customer_id AND n.order_date > p.order_date
              GROUP BY n.customer_id, n.order_date)
        WHERE g >= 60 GROUP BY customer_id""",
    "month_reactivations": with_views("by_month") + """
        SELECT customer_id, COUNT(*) AS active_months,
               COUNT(*) FILTER (WHERE back >= 3) AS reactivation_count,
               CAST(MAX(days) AS INTEGER) AS max_month_gap_days
        FROM (SELECT customer_id, date_diff('month', LAG(m) OVER w, m) AS back,
                     m - LAG(m) OVER w AS days
              FROM by_month WINDOW w AS (PARTITION BY customer_id ORDER BY m))
        GROUP BY customer_id""",
    "months_since_first": with_views("by_month") + """
        SELECT customer_id, m AS sales_month, f AS cohort_month,
               CAST(date_diff('month', f, m) AS INTEGER) AS months_since_first
        FROM by_month JOIN (SELECT customer_id, MIN(m) AS f FROM by_month GROUP BY ALL)
             USING (customer_id)""",
    "cohorts": with_views("by_month") + f""",
        c AS (SELECT customer_id, MIN(m) AS cohort_month, MAX(m) AS latest_month,
                     CAST(SUM(v) AS DECIMAL(28,2)) AS lifetime_revenue
              FROM by_month GROUP BY customer_id)
        SELECT *, CAST(date_diff('month', cohort_month, latest_month) AS INTEGER)
                      AS months_since_first,
               CAST(SUM(lifetime_revenue) OVER w AS DECIMAL(28,2)) AS cohort_total_revenue,
               {pct('lifetime_revenue', 'SUM(lifetime_revenue) OVER w')}
                   AS cohort_revenue_percentage
        FROM c WINDOW w AS (PARTITION BY cohort_month)""",
    "yoy": with_views("sales") + f""",
        y AS (SELECT salesperson_id, CAST(year(order_date) AS INTEGER) AS sales_year,
                     CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS yearly_revenue
              FROM sales GROUP BY ALL)
        SELECT y.*, p.yearly_revenue AS previous_year_revenue,
               {pct('y.yearly_revenue - p.yearly_revenue', 'p.yearly_revenue')} AS yoy_growth
        FROM y ASOF LEFT JOIN y p
          ON y.salesperson_id = p.salesperson_id AND y.sales_year > p.sales_year""",
    "third_highest_salary": with_views("staff") + """
        SELECT (SELECT DISTINCT salary FROM staff WHERE salary IS NOT NULL
                ORDER BY salary DESC LIMIT 1 OFFSET 2) AS nth_highest""",
    "second_highest_salary": with_views("staff") + """
        SELECT (SELECT DISTINCT salary FROM staff WHERE salary IS NOT NULL
                ORDER BY salary DESC LIMIT 1 OFFSET 1) AS second_highest_salary""",
    "rows_at_third_highest_salary": with_views("staff") + """
        SELECT emp_id, salary FROM staff WHERE salary IS NOT NULL
        QUALIFY DENSE_RANK() OVER (ORDER BY salary DESC) = 3""",
    "top_products_per_region_with_ties": with_views("shop") + """
        SELECT region, product, CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS revenue
        FROM shop GROUP BY region, product
        QUALIFY DENSE_RANK() OVER (PARTITION BY region ORDER BY SUM(sales_amount) DESC) <= 2""",
    "top_salaries_per_department_rank": with_views("staff") + """
        SELECT emp_id, dept, salary, CAST(rnk AS INTEGER) AS rnk
        FROM (SELECT *, RANK() OVER (PARTITION BY dept ORDER BY salary DESC NULLS LAST) AS rnk
              FROM staff)
        WHERE rnk <= 10""",
    "top_salaries_per_department": with_views("staff") + """
        SELECT emp_id, dept, salary, CAST(rnk AS INTEGER) AS rnk
        FROM (SELECT *, ROW_NUMBER() OVER (
                  PARTITION BY dept ORDER BY salary DESC NULLS LAST, emp_id) AS rnk
              FROM staff)
        WHERE rnk <= 3""",
    "top_orders": with_views("placed") + """
        SELECT * FROM placed ORDER BY amount DESC, order_id LIMIT 5""",
    "duplicates": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS duplicate_count
        FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1""",
    "dedupe_keep_latest": """
        WITH numbered AS (
            SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS ship_date, l_partkey,
                   l_suppkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
                   ROW_NUMBER() OVER (PARTITION BY l_orderkey, l_linenumber
                       ORDER BY CAST(l_shipdate AS DATE) DESC, l_partkey, l_suppkey,
                                CAST(l_extendedprice AS DECIMAL(18,2))) AS n
            FROM lineitem)
        SELECT * EXCLUDE (n) FROM numbered WHERE n = 1""",
    "dedupe_employees": with_views("staff") + """
        SELECT emp_id, dept, join_date FROM staff
        QUALIFY ROW_NUMBER() OVER (PARTITION BY dept, dept_id
                                   ORDER BY join_date DESC, emp_id) = 1""",
    "department_headcount_pct": with_views("staff") + """
        SELECT dept, COUNT(*) AS employee_count,
               COUNT(*) * CAST(100 AS DOUBLE) / (SELECT COUNT(*) FROM staff)
                   AS employee_percentage
        FROM staff GROUP BY dept""",
    "customers_with_orders": """
        SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer
        WHERE c_custkey IN (SELECT o_custkey FROM orders)""",
    "customers_without_orders": """
        SELECT c_custkey AS customer_id, c_name AS customer_name
        FROM customer ANTI JOIN orders ON c_custkey = o_custkey""",
    "customers_without_events": """
        SELECT c_custkey AS customer_id, c_name AS customer_name FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = c_custkey)""",
    "orders_without_lines": with_views("placed") + """
        SELECT * FROM placed WHERE NOT EXISTS (
            SELECT 1 FROM lineitem WHERE l_orderkey = order_id)""",
    "peers_of_highest_paid": with_views("staff") + """
        SELECT emp_id, emp_name, dept FROM staff
        QUALIFY MAX(salary) OVER (PARTITION BY dept) = MAX(salary) OVER ()""",
    "employees_with_manager": with_views("staff") + """
        SELECT e.emp_id, e.emp_name AS employee, m.emp_name AS manager
        FROM staff e LEFT JOIN staff m ON m.emp_id = e.manager_id""",
    "employees_without_manager": with_views("staff") + """
        SELECT emp_id, emp_name FROM staff WHERE manager_id IS NULL""",
    "compare_ranks": with_views("staff") + """
        SELECT emp_id, emp_name, salary,
               ROW_NUMBER() OVER (ORDER BY salary DESC NULLS LAST, emp_id) AS row_num,
               RANK() OVER (ORDER BY salary DESC NULLS LAST) AS salary_rank,
               DENSE_RANK() OVER (ORDER BY salary DESC NULLS LAST) AS salary_dense_rank
        FROM staff""",
    "inner_join_departments": with_views("staff", "units") + """
        SELECT emp_id, emp_name, dept_name FROM staff INNER JOIN units USING (dept_id)""",
    "left_join_departments": with_views("staff", "units") + """
        SELECT emp_id, emp_name, dept_name FROM staff LEFT JOIN units USING (dept_id)""",
    "full_join_departments": with_views("staff", "units") + """
        SELECT emp_id, emp_name, dept_name FROM staff FULL JOIN units USING (dept_id)""",
    "departments_above_average_salary": with_views("staff") + f"""
        SELECT dept, {avg6('SUM(salary)', 'COUNT(salary)')} AS avg_salary FROM staff
        GROUP BY dept HAVING SUM(salary) > 4500 * COUNT(salary)""",
    "staff_union": with_views("placed") + """
        SELECT c_name AS employee_name FROM placed JOIN customer ON c_custkey = customer_id
        WHERE year(order_date) = 1999
        UNION
        SELECT c_name FROM placed JOIN customer ON c_custkey = customer_id
        WHERE year(order_date) = 2000""",
    "staff_union_all": with_views("placed") + """
        SELECT c_name AS employee_name FROM placed JOIN customer ON c_custkey = customer_id
        WHERE year(order_date) BETWEEN 1999 AND 2000""",
    "salary_or_zero": with_views("staff") + """
        SELECT emp_id, emp_name, CAST(IFNULL(salary, 0) AS DECIMAL(12,2)) AS salary FROM staff""",
    "orders_in_year": with_views("placed") + """
        SELECT * FROM placed WHERE year(order_date) = 2000""",
    "partitioned_sales": with_views("placed") + """
        SELECT order_id AS sale_id, order_date AS sale_date, amount AS revenue
        FROM placed WHERE order_date BETWEEN DATE '1999-11-15' AND DATE '2000-02-10'""",
    "annual_salaries": with_views("staff") + """
        SELECT emp_id, CAST(salary * 12 AS DECIMAL(12,2)) AS annual_salary FROM staff""",
    "employees_of_department": with_views("staff") + """
        SELECT emp_id, emp_name, dept_id FROM staff WHERE dept_id = 10""",
    "employees_by_statement": with_views("staff") + """
        SELECT emp_id, emp_name, dept_id FROM staff WHERE dept_id = 10""",
    "balances_after_transfers": """
        WITH moves AS (
            SELECT o_custkey AS account_id, -CAST(o_totalprice AS DECIMAL(18,2)) AS delta
            FROM orders
            UNION ALL
            SELECT xor(o_custkey, 1), CAST(o_totalprice AS DECIMAL(18,2)) FROM orders)
        SELECT account_id, CAST(SUM(delta) AS DECIMAL(28,2)) AS balance
        FROM (SELECT * FROM moves UNION ALL
              SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) FROM customer)
        GROUP BY account_id""",
}

# The same results by another way.
OPERATORS["activity_streaks_by_bits"] = OPERATORS["activity_streaks_by_month"]
OPERATORS["activity_streaks_by_session"] = OPERATORS["activity_streaks_by_day"]
OPERATORS["month_reactivations_by_bits"] = OPERATORS["month_reactivations"]

STATEMENTS = {**OPERATORS, **TOPICS, **REPORTS}
