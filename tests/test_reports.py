"""Reports at their default thresholds on hand-made rows."""

import pytest

from grainline import plans

SALES = "customer_id bigint; order_date date; sales_amount decimal(18,2)"


@pytest.fixture
def buyers(frame):
    return frame(
        "customer_id bigint; customer_name string; segment string; region string",
        *[(i, f"c{i}", "s", "north" if i < 10 else "south") for i in range(1, 13)],
    )


def sales(frame, *customers):
    return frame(SALES, *[(c, d, v) for c, days in customers for d, v in days])


RISING = [("2023-11-05", 1), ("2023-12-05", 2), ("2024-01-05", 3), ("2024-02-05", 4)]


def test_monthly_performance(frame, buyers, rows):
    fact = sales(
        frame,
        (1, RISING),
        (2, RISING[:3]),  # two rises are not enough
        (3, [*RISING, ("2024-03-01", 4)]),  # the latest month did not rise
        (4, [*RISING, ("2024-06-01", 5)]),  # rose after a gap: streak stays 3
        (99, RISING),  # not a known customer
    )
    found = plans.customer_monthly_performance(fact, buyers, extra=True)
    assert rows(found) == [
        (1, "2024-02-01", 4.0, 3.0, 33.33, 3.0, 3, 10.0),
        (4, "2024-06-01", 5.0, 4.0, 25.0, 4.0, 3, 15.0),
    ]


def test_lifecycle_and_its_two_streaks(frame, buyers, rows):
    pause = [(d, 10 * v) for d, v in RISING] + [("2024-08-01", 50)]
    flat = [(d, 50) for d, _ in RISING] + [("2024-08-01", 60)]
    fact = sales(frame, (1, pause), (2, flat), (3, [("2024-01-01", 1)]), (99, [("2024-01-01", 1)]))
    found = plans.customer_lifecycle(fact, buyers)
    assert rows(found) == [
        (1, "c1", "s", "north", 150.0, 3, 178, 1, "2024-08-01", 50.0, 25.0, 1),
    ]
    active = plans.customer_lifecycle(fact, buyers, streak="activity")
    assert rows(active, "customer_id", "longest_monthly_streak", "regional_rank") == [
        (1, 4, 2), (2, 4, 1),
    ]


def test_lifecycle_average_includes_customers_without_a_row(frame, buyers, rows):
    pause = RISING + [("2024-08-01", 5)]
    rich = [("2024-01-01", 1000)]
    assert rows(plans.customer_lifecycle(sales(frame, (1, pause), (2, RISING[:1])), buyers)) != []
    assert rows(plans.customer_lifecycle(sales(frame, (1, pause), (99, rich)), buyers)) == []
    assert rows(plans.customer_lifecycle(sales(frame, (1, pause), (None, rich)), buyers)) == []


def test_retention_boundaries(frame, buyers, rows):
    base = [("2024-01-31", 10), ("2024-02-01", 10), ("2024-03-01", 10)]
    fact = sales(
        frame,
        (1, base + [("2024-06-01", 10)]),  # back after three months
        (2, base + [("2024-05-31", 10)]),  # two months later only
        (3, [*base[:2], ("2024-06-01", 10), ("2024-07-01", 10)]),  # no three in a row
        (4, base),  # three months only
        (5, [("2024-01-01", 1)]),
    )
    found = plans.customer_retention(fact, buyers, extra=True)
    assert rows(found) == [(1, "c1", "s", "north", 40.0, 4, 92, 1, 3, 92, 1)]


def test_retention_keeps_five_per_region(frame, buyers, rows):
    days = [("2024-01-31", 10), ("2024-02-01", 10), ("2024-03-01", 10), ("2024-06-01", 10)]
    fact = sales(frame, *[(c, days) for c in range(1, 8)], (11, days), (12, [("2024-01-01", 1)]))
    found = plans.customer_retention(fact, buyers)
    assert rows(found, "region", "regional_rank", "customer_id") == [
        *[("north", i, i) for i in range(1, 6)],
        ("south", 1, 11),
    ]


def test_cohorts_give_every_known_customer(frame, buyers, rows):
    fact = sales(
        frame,
        (1, [("2024-01-02", 10), ("2024-01-09", 20), ("2024-03-01", 30)]),
        (2, [("2024-01-02", 40)]),
        (3, [("2024-02-01", 5), ("2024-03-01", 5), ("2024-04-01", 5)]),
        (4, [("2024-02-01", None)]),
        (99, [("2024-01-01", 1000)]),
    )
    found = plans.customer_cohorts(fact, buyers, extra=True)
    shown = rows(
        found, "customer_id", "cohort_month", "lifetime_revenue", "latest_month",
        "months_since_first_purchase", "cumulative_revenue", "rolling_3_month_revenue",
        "highest_revenue_month", "cohort_revenue_percentage", "longest_purchase_streak",
        "has_3_month_streak",
    )
    assert shown == [
        (1, "2024-01-01", 60.0, "2024-03-01", 2, 60.0, 30.0, "2024-01-01", 60.0, 1, False),
        (2, "2024-01-01", 40.0, "2024-01-01", 0, 40.0, 40.0, "2024-01-01", 40.0, 1, False),
        (3, "2024-02-01", 15.0, "2024-04-01", 2, 15.0, 5.0, "2024-02-01", 100.0, 3, True),
        (4, "2024-02-01", None, "2024-02-01", 0, None, None, "2024-02-01", None, 1, False),
    ]


@pytest.fixture
def goods(frame):
    return frame(
        "product_id string; product_name string; category string",
        ("p1", "P1", "c"), ("p2", "P2", "c"), ("p3", "P3", "c"), ("p4", "P4", "c"), ("q", "Q", "d"),
    )


def product_sales(frame, **products):
    return frame(
        "product_id string; order_date date; sales_amount decimal(18,2)",
        *[(p, d, v) for p, days in products.items() for d, v in days],
    )


def test_top_products_break_ties_by_id(frame, goods, rows):
    fact = product_sales(frame, **{p: [("2024-01-01", 5)] for p in ("p4", "p3", "p2", "p1", "q")})
    found = plans.top_products(fact, goods)
    assert rows(found, "category", "category_rank", "product_id", "category_revenue_percentage") == [
        ("c", 1, "p1", 25.0), ("c", 2, "p2", 25.0), ("c", 3, "p3", 25.0), ("d", 1, "q", 100.0),
    ]


def test_dominance_needs_to_be_above_the_average(frame, goods, rows):
    rising = [(d, 10 * v) for d, v in RISING]
    fact = product_sales(frame, p1=rising, p2=[("2024-01-01", 50)], q=rising)
    found = plans.product_dominance(fact, goods)
    assert rows(found) == [
        ("p1", "P1", "c", 100.0, 150.0, 75.0, 66.67, 3, "2024-02-01", 40.0, 33.33, 1),
    ]
    narrower = plans.category_performance(fact, goods, min_share=67)
    assert rows(narrower) == []
    assert "category_revenue" not in narrower.columns


@pytest.fixture
def sellers(frame):
    return frame(
        "salesperson_id int; salesperson_name string; region string",
        (1, "one", "north"), (2, "two", "north"), (3, "three", "north"),
    )


def test_salesperson_years_and_quarters(frame, sellers, rows):
    year = [("2022-05-01", 8)] + [(f"2023-{m:02}-10", m) for m in (1, 2, 3, 4)] + [("2023-07-01", 6)]
    fact = frame(
        "salesperson_id int; order_date date; sales_amount decimal(18,2)",
        *[(1, d, v) for d, v in year],
        (1, "2024-01-01", 1),
        *[(2, d, 10 * v) for d, v in year],
        (3, "2023-01-01", 10),
    )
    found = plans.regional_performance(fact, sellers, as_of="2024-01-01")
    assert rows(found) == [
        # the second quarter of 2022 had 8, the first of 2023 had 6
        (2, "two", "north", 3, 2023, 160.0, 100.0, 43.333333, 2, 80.0, 87.59, 1),
    ]
    everyone = plans.salesperson_performance(fact, sellers, min_share=0, as_of="2024-01-01", extra=True)
    assert rows(everyone, "salesperson_id", "mom_growth", "regional_rank") == [(1, 50.0, 2), (2, 50.0, 1)]
    assert rows(plans.regional_performance(fact, sellers)) != rows(found)


def test_attendance_counts_a_day_once(frame, rows):
    days = "employee_id bigint; attendance_date date; attendance_status string"
    fact = frame(
        days,
        (1, "2024-02-28", "Present"), (1, "2024-02-28", "Present"), (1, "2024-02-29", "Present"),
        (1, "2024-03-01", "Present"), (1, "2024-03-05", "Present"), (1, "2024-03-02", "Absent"),
        *[(e, "2024-01-01", "Present") for e in range(2, 8)],
        (8, "2024-01-01", "Absent"),
    )
    people = frame(
        "employee_id bigint; employee_name string; department string",
        *[(e, f"e{e}", "d") for e in range(1, 9)],
    )
    found = plans.attendance_streaks(fact, people)
    assert rows(found) == [
        (1, "e1", "d", 4, 3, "2024-03-05"),
        *[(e, f"e{e}", "d", 1, 1, "2024-01-01") for e in range(2, 6)],
    ]
