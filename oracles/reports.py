"""SQL statements of the reports."""

from __future__ import annotations

from oracles.views import avg2, avg6, pct, with_views


def _growth_profile(source: str, key: str) -> str:
    """CTE ``profile``: longest run of rises, last two active months, lifetime."""
    return f""",
        marked AS (
            SELECT {key}, m, v, LAG(v) OVER w AS pv,
                   ROW_NUMBER() OVER w AS pos,
                   COALESCE(v > LAG(v) OVER w
                            AND LAG(m) OVER w + INTERVAL 1 MONTH = m, FALSE) AS rises
            FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY m)),
        counted AS (
            SELECT *, pos - MAX(CASE WHEN rises THEN 0 ELSE pos END) OVER (
                       PARTITION BY {key} ORDER BY m) AS rises_so_far
            FROM marked),
        profile AS (
            SELECT {key}, CAST(SUM(v) AS DECIMAL(28,2)) AS lifetime,
                   CAST(MAX(rises_so_far) AS BIGINT) AS longest, MAX(m) AS last_m,
                   arg_max(v, m) AS last_v,
                   arg_max_null(pv, m) AS last_pv
            FROM counted GROUP BY {key})"""


def customer_monthly(min_streak: int, extra: bool = False) -> str:
    return (
        with_views("by_month", "buyers")
        + _growth_profile("by_month", "customer_id")
        + f""",
        last3 AS (
            SELECT customer_id, {avg2('SUM(v)', 'COUNT(*)')} AS rolling_avg_3m
            FROM (SELECT * FROM by_month
                  QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY m DESC) <= 3)
            GROUP BY customer_id)
        SELECT customer_id, last_m AS latest_month, last_v AS latest_month_revenue,
               last_pv AS previous_month_revenue,
               {pct('last_v - last_pv', 'last_pv')} AS mom_growth,
               rolling_avg_3m, longest AS longest_monthly_streak
               {', lifetime AS running_revenue' if extra else ''}
        FROM profile NATURAL JOIN last3 NATURAL JOIN (SELECT customer_id FROM buyers)
        WHERE longest >= {min_streak} AND last_v > last_pv"""
    )


def customer_lifecycle(min_streak: int, streak: str = "growth") -> str:
    months_in_a_row = """,
        islands AS (
            SELECT customer_id, COUNT(*) AS n FROM (
                SELECT customer_id, year(m) * 12 + month(m)
                       - ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY m) AS island
                FROM by_month)
            GROUP BY customer_id, island),
        active AS (SELECT customer_id, MAX(n) AS active_run FROM islands GROUP BY customer_id)"""
    length = "longest" if streak == "growth" else "active_run"
    return (
        with_views("by_month", "buyers")
        + _growth_profile("by_month", "customer_id")
        + months_in_a_row
        + f""",
        pauses AS (
            SELECT customer_id, CAST(MAX(days) AS INTEGER) AS max_inactive_days,
                   COUNT(*) AS reactivation_count
            FROM (SELECT customer_id, order_date - LAG(order_date) OVER (
                             PARTITION BY customer_id ORDER BY order_date) AS days
                  FROM sales)
            WHERE days >= 60 GROUP BY customer_id)
        SELECT customer_id, customer_name, segment, region, lifetime AS lifetime_revenue,
               {length} AS longest_monthly_streak, max_inactive_days, reactivation_count,
               last_m AS latest_month, last_v AS latest_month_revenue,
               {pct('last_v - last_pv', 'last_pv')} AS latest_mom_growth,
               CAST(ROW_NUMBER() OVER (PARTITION BY region
                    ORDER BY lifetime DESC, customer_id) AS INTEGER) AS regional_rank
        FROM profile NATURAL JOIN active NATURAL JOIN pauses NATURAL JOIN buyers
        WHERE lifetime * (SELECT COUNT(*) FROM profile) > (SELECT SUM(lifetime) FROM profile)
          AND {length} >= {min_streak} AND {pct('last_v - last_pv', 'last_pv')} > 0
        QUALIFY regional_rank <= 5"""
    )


def product_dominance(min_share: int, average_name: str, with_total: bool) -> str:
    return (
        with_views("goods_by_month", "goods")
        + _growth_profile("goods_by_month", "product_id")
        + f""",
        by_category AS (
            SELECT category, CAST(SUM(lifetime) AS DECIMAL(28,2)) AS whole, COUNT(*) AS members
            FROM profile NATURAL JOIN goods GROUP BY category)
        SELECT product_id, product_name, category, lifetime AS lifetime_revenue,
               {'whole AS category_revenue,' if with_total else ''}
               {avg6('whole', 'members')} AS {average_name},
               {pct('lifetime', 'whole')} AS category_contribution_pct,
               longest AS longest_growth_streak, last_m AS latest_month,
               last_v AS latest_month_revenue,
               {pct('last_v - last_pv', 'last_pv')} AS latest_mom_growth,
               CAST(ROW_NUMBER() OVER (PARTITION BY category
                    ORDER BY lifetime DESC, product_id) AS INTEGER) AS category_rank
        FROM profile NATURAL JOIN goods NATURAL JOIN by_category
        WHERE lifetime * members > whole AND {pct('lifetime', 'whole')} >= {min_share}
          AND longest >= 3 AND {pct('last_v - last_pv', 'last_pv')} > 0
        QUALIFY category_rank <= 3"""
    )


def salesperson(with_rolling: bool, until: str | None = None, extra: bool = False) -> str:
    return (
        with_views("sales", "sellers")
        + f""",
        seller_months AS (
            SELECT salesperson_id, CAST(date_trunc('month', order_date) AS DATE) AS m,
                   CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS v
            FROM sales {f"WHERE order_date < DATE '{until}'" if until else ''} GROUP BY ALL)"""
        + _growth_profile("seller_months", "salesperson_id")
        + f""",
        years AS (
            SELECT salesperson_id, CAST(year(m) AS INTEGER) AS y,
                   CAST(SUM(v) AS DECIMAL(28,2)) AS yv
            FROM seller_months GROUP BY ALL),
        last_two AS (
            SELECT salesperson_id, MAX(y) AS y, arg_max(yv, y) AS yv, arg_max(yv, y, 2)[2] AS pyv
            FROM years GROUP BY salesperson_id),
        quarters AS (
            SELECT DISTINCT ON (salesperson_id) salesperson_id, q, qv FROM (
                SELECT salesperson_id, year(m) AS y, CAST(quarter(m) AS INTEGER) AS q,
                       CAST(SUM(v) AS DECIMAL(28,2)) AS qv
                FROM seller_months GROUP BY ALL)
            ORDER BY salesperson_id, qv DESC, y, q),
        regions AS (
            SELECT region, SUM(lifetime) AS whole
            FROM profile NATURAL JOIN sellers GROUP BY region),
        last3 AS (
            SELECT salesperson_id, {avg6('SUM(v)', 'COUNT(*)')} AS rolling_3_month_revenue
            FROM (SELECT * FROM seller_months
                  QUALIFY ROW_NUMBER() OVER (PARTITION BY salesperson_id ORDER BY m DESC) <= 3)
            GROUP BY salesperson_id)
        SELECT salesperson_id, salesperson_name, region, longest AS longest_growth_streak,
               y AS sales_year, yv AS yearly_revenue, {pct('yv - pyv', 'pyv')} AS yoy_growth,
               {'rolling_3_month_revenue,' if with_rolling else ''}
               {f"{pct('last_v - last_pv', 'last_pv')} AS mom_growth," if extra else ''}
               q AS sales_quarter, qv AS highest_quarterly_revenue,
               {pct('lifetime', 'whole')} AS regional_contribution_pct,
               CAST(ROW_NUMBER() OVER (PARTITION BY region ORDER BY yv DESC, salesperson_id)
                    AS INTEGER) AS regional_rank
        FROM profile NATURAL JOIN last_two NATURAL JOIN quarters NATURAL JOIN last3
             NATURAL JOIN sellers NATURAL JOIN regions
        WHERE longest >= 3 AND {pct('yv - pyv', 'pyv')} > 0
          AND {pct('lifetime', 'whole')} >= 10
        QUALIFY regional_rank <= 3"""
    )


TOP_PRODUCTS = (
    with_views("sales", "goods")
    + f""",
    p AS (SELECT category, product_id, product_name,
                 CAST(SUM(sales_amount) AS DECIMAL(28,2)) AS total_revenue
          FROM sales NATURAL JOIN goods GROUP BY ALL)
    SELECT category, product_id, product_name, total_revenue,
           {pct('total_revenue', 'SUM(total_revenue) OVER (PARTITION BY category)')}
               AS category_revenue_percentage,
           CAST(ROW_NUMBER() OVER (PARTITION BY category
                ORDER BY total_revenue DESC, product_id) AS INTEGER) AS category_rank
    FROM p QUALIFY category_rank <= 3"""
)

ATTENDANCE = (
    with_views("present")
    + """,
    runs AS (
        SELECT employee_id, COUNT(*) AS n, MAX(attendance_date) AS last_day
        FROM (SELECT *, attendance_date - CAST(ROW_NUMBER() OVER (
                     PARTITION BY employee_id ORDER BY attendance_date) AS INTEGER) AS island
              FROM present)
        GROUP BY employee_id, island)
    SELECT employee_id, 'employee-' || employee_id AS employee_name,
           CAST(employee_id % 5 AS VARCHAR) AS department,
           CAST(SUM(n) AS BIGINT) AS total_present_days, MAX(n) AS longest_present_streak,
           MAX(last_day) AS latest_attendance_date
    FROM runs GROUP BY employee_id
    ORDER BY longest_present_streak DESC, employee_id LIMIT 5"""
)

COHORTS = (
    with_views("by_month", "buyers")
    + f""",
    islands AS (
        SELECT customer_id, COUNT(*) AS n FROM (
            SELECT customer_id, year(m) * 12 + month(m)
                   - ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY m) AS island
            FROM by_month)
        GROUP BY customer_id, island),
    streak AS (SELECT customer_id, MAX(n) AS longest_purchase_streak
               FROM islands GROUP BY customer_id),
    best AS (SELECT DISTINCT ON (customer_id) customer_id, v AS highest_monthly_revenue,
                    m AS highest_revenue_month
             FROM by_month ORDER BY customer_id, v DESC, m),
    last3 AS (SELECT customer_id, {avg2('SUM(v)', 'COUNT(*)')} AS rolling_3_month_revenue
              FROM (SELECT * FROM by_month
                    QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY m DESC) <= 3)
              GROUP BY customer_id),
    life AS (SELECT customer_id, MIN(m) AS cohort_month, MAX(m) AS latest_month,
                    arg_max(v, m) AS latest_month_revenue,
                    CAST(SUM(v) AS DECIMAL(28,2)) AS lifetime_revenue
             FROM by_month NATURAL JOIN (SELECT customer_id FROM buyers) GROUP BY customer_id),
    totals AS (SELECT cohort_month, SUM(lifetime_revenue) AS whole FROM life GROUP BY cohort_month)
    SELECT customer_id, customer_name, segment, region, cohort_month, lifetime_revenue,
           latest_month, latest_month_revenue,
           CAST(date_diff('month', cohort_month, latest_month) AS INTEGER)
               AS months_since_first_purchase,
           lifetime_revenue AS cumulative_revenue, rolling_3_month_revenue,
           highest_monthly_revenue, highest_revenue_month,
           {pct('lifetime_revenue', 'whole')} AS cohort_revenue_percentage,
           longest_purchase_streak, longest_purchase_streak >= 3 AS has_3_month_streak
    FROM life NATURAL JOIN buyers NATURAL JOIN streak NATURAL JOIN best NATURAL JOIN last3
         NATURAL JOIN totals"""
)

RETENTION = (
    with_views("by_month", "buyers")
    + """,
    islands AS (
        SELECT customer_id, COUNT(*) AS n FROM (
            SELECT customer_id, year(m) * 12 + month(m)
                   - ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY m) AS island
            FROM by_month)
        GROUP BY customer_id, island),
    streak AS (SELECT customer_id, MAX(n) AS longest_purchase_streak
               FROM islands GROUP BY customer_id),
    returns AS (
        SELECT customer_id, COUNT(*) AS active_months, MAX(days) AS max_month_gap_days,
               COUNT(*) FILTER (WHERE back >= 3) AS reactivation_count
        FROM (SELECT customer_id, date_diff('month', LAG(m) OVER w, m) AS back,
                     CAST(m - LAG(m) OVER w AS INTEGER) AS days
              FROM by_month WINDOW w AS (PARTITION BY customer_id ORDER BY m))
        GROUP BY customer_id),
    pauses AS (
        SELECT customer_id, CAST(MAX(days) AS INTEGER) AS max_inactive_days
        FROM (SELECT customer_id, order_date - LAG(order_date) OVER (
                         PARTITION BY customer_id ORDER BY order_date) AS days
              FROM sales)
        GROUP BY customer_id),
    life AS (SELECT customer_id, CAST(SUM(v) AS DECIMAL(28,2)) AS lifetime_revenue
             FROM by_month GROUP BY customer_id)
    SELECT customer_id, customer_name, segment, region, lifetime_revenue, active_months,
           max_inactive_days, reactivation_count, longest_purchase_streak, max_month_gap_days,
           CAST(ROW_NUMBER() OVER (PARTITION BY region
                ORDER BY lifetime_revenue DESC, customer_id) AS INTEGER) AS regional_rank
    FROM life NATURAL JOIN returns NATURAL JOIN pauses NATURAL JOIN streak NATURAL JOIN buyers
    WHERE lifetime_revenue * (SELECT COUNT(*) FROM life) > (SELECT SUM(lifetime_revenue) FROM life)
      AND active_months >= 4 AND max_inactive_days >= 60 AND reactivation_count >= 1
      AND longest_purchase_streak >= 3
    QUALIFY regional_rank <= 5"""
)

REPORTS = {
    "report_customer_monthly_performance": customer_monthly(3),
    "report_customer_monthly_performance_two_rises": customer_monthly(2, extra=True),
    "report_top_products": TOP_PRODUCTS,
    "report_attendance_streaks": ATTENDANCE,
    "report_customer_lifecycle": customer_lifecycle(3),
    "report_customer_lifecycle_two_rises": customer_lifecycle(2),
    "report_customer_lifecycle_activity": customer_lifecycle(3, "activity"),
    "report_product_dominance": product_dominance(10, "category_avg_revenue", True),
    "report_salesperson_performance": salesperson(with_rolling=False),
    "report_salesperson_performance_until_2001": salesperson(False, "2001-01-01"),
    "report_salesperson_performance_extra": salesperson(False, "2001-01-01", extra=True),
    "report_customer_cohorts": COHORTS,
    "report_customer_retention": RETENTION,
    "report_category_performance": product_dominance(15, "category_average_revenue", False),
    "report_category_performance_18": product_dominance(18, "category_average_revenue", False),
    "report_regional_performance": salesperson(with_rolling=True),
    "report_regional_performance_until_2001": salesperson(True, "2001-01-01"),
    "report_regional_performance_extra": salesperson(True, "2001-01-01", extra=True),
}
