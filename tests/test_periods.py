"""Roll-ups, previous periods, rolling measures, streaks, gaps and cohorts."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from grainline import operators as op

FIRST = date(2023, 6, 1)

MONTHS = "k string; m date; v decimal(18,2)"


def months(frame, *values, key="a"):
    return frame(MONTHS, *[(key, m, v) for m, v in values])


def test_period_revenue_sums_days_of_a_month(frame, rows):
    fact = frame(
        "k string; d date; v decimal(18,2)",
        ("a", "2024-01-01", 1),
        ("a", "2024-01-31", 2),
        ("a", "2024-02-01", 4),
        ("b", "2024-01-15", 8),
        ("z", "2024-01-15", 8),
    )
    dim = frame("k string; name string", ("a", "A"), ("b", "B"))
    found = op.period_revenue(fact, "k", "d", "v", dim=dim, attrs="name")
    assert rows(found, "k", "name", "sales_month", "monthly_revenue") == [
        ("a", "A", "2024-01-01", 3.0),
        ("a", "A", "2024-02-01", 4.0),
        ("b", "B", "2024-01-01", 8.0),
    ]


def test_previous_is_the_last_active_month(frame, rows):
    df = months(frame, ("2024-01", 1), ("2024-02", 2), ("2024-04", 3))
    found = op.with_previous(df, "k", "m", ["m", "v"])
    assert rows(found, "m", "previous_m", "previous_v") == [
        ("2024-01-01", None, None),
        ("2024-02-01", "2024-01-01", 1.0),
        ("2024-04-01", "2024-02-01", 2.0),
    ]


def test_streaks_across_the_year(frame, rows):
    df = months(frame, ("2023-11", 1), ("2023-12", 2), ("2024-01", 3), ("2024-02", 4))
    assert rows(op.longest_streak(df, "k", "m", "v")) == [("a", 3)]
    assert rows(op.longest_streak(df, "k", "m", mode="activity")) == [("a", 4)]


def test_gap_month_ends_growth(frame, rows):
    df = months(frame, ("2024-01", 1), ("2024-02", 2), ("2024-04", 3), ("2024-05", 4))
    assert rows(op.streaks(df, "k", "m", "v")) == [
        ("a", "2024-01-01", "2024-02-01", 1),
        ("a", "2024-04-01", "2024-05-01", 1),
    ]


def test_equal_revenue_is_no_growth(frame, rows):
    df = months(frame, ("2024-01", 1), ("2024-02", 1), ("2024-03", 2))
    assert rows(op.longest_streak(df, "k", "m", "v")) == [("a", 1)]


def test_single_month_never_grew_but_was_active(frame, rows):
    df = months(frame, ("2024-01", 1))
    assert rows(op.longest_streak(df, "k", "m", "v")) == []
    assert rows(op.longest_streak(df, "k", "m", mode="activity")) == [("a", 1)]


def test_unknown_revenue_breaks_growth(frame, rows):
    df = months(frame, ("2024-01", 1), ("2024-02", None), ("2024-03", 2), ("2024-04", 3))
    assert rows(op.streaks(df, "k", "m", "v")) == [("a", "2024-03-01", "2024-04-01", 1)]


def test_day_streaks(frame, rows):
    days = ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01", "2024-03-03"]
    df = frame("k string; m date", *[("a", d) for d in days])
    assert rows(op.streaks(df, "k", "m", mode="activity", unit="day")) == [
        ("a", "2024-02-27", "2024-03-01", 4),
        ("a", "2024-03-03", "2024-03-03", 1),
    ]


def test_rolling_uses_active_rows(frame, rows):
    df = months(frame, ("2024-01", 1), ("2024-02", 2), ("2024-06", 3), ("2024-07", "7.01"))
    average = op.rolling(df, "k", "m", "v", out="r")
    assert [r[0] for r in rows(average, "r")] == [1.0, 1.5, 2.0, 4.0]
    total = op.rolling(df, "k", "m", "v", fn="sum", digits=None, out="r")
    assert [r[0] for r in rows(total, "r")] == [1.0, 3.0, 6.0, 12.01]


def test_best_period_prefers_the_earliest(frame, rows):
    df = months(frame, ("2024-01", 1), ("2024-02", 5), ("2024-03", 5), ("2024-04", None))
    assert rows(op.best_period(df, "k", "v", tie="m")) == [("a", "2024-02-01", 5.0)]
    assert rows(op.latest(df, "k", "m")) == [("a", "2024-04-01", None)]


def test_yoy_compares_with_the_last_active_year(frame, rows):
    df = months(frame, ("2021-01", 10), ("2023-01", 10), ("2023-05", 5), ("2024-01", 0))
    assert rows(op.yoy(df, "k", "m", "v"), "sales_year", "yearly_revenue", "yoy_growth") == [
        (2021, 10.0, None),
        (2023, 15.0, 50.0),
        (2024, 0.0, -100.0),
    ]


def test_sixty_day_boundary(frame, rows):
    days = ("2024-01-01", "2024-02-29", "2024-04-29", "2024-06-29")  # gaps 59, 60, 61
    fact = frame("k string; d date", *[("a", d) for d in days], ("b", "2024-01-01"))
    assert rows(op.inactivity_gaps(fact, "k", "d")) == [("a", 61, 2)]


def test_same_day_purchases_add_no_gap(frame, rows):
    fact = frame("k string; d date", ("a", "2024-01-01"), ("a", "2024-01-01"), ("a", "2024-04-01"))
    assert rows(op.purchase_gaps(fact, "k", "d"), "inactive_days") == [(91,), (None,)]


def test_three_month_boundary(frame, rows):
    near = months(frame, ("2024-01", 1), ("2024-03", 1))
    far = months(frame, ("2024-01", 1), ("2024-04", 1), key="b")
    found = op.month_reactivations(near.union(far), "k", "m", extra=True)
    assert rows(found) == [("a", 2, 0, 60), ("b", 2, 1, 91)]


def test_cohorts(frame, rows):
    df = frame(
        MONTHS,
        ("a", "2024-01", 1),
        ("a", "2024-05", 2),
        ("b", "2024-01", 1),
        ("c", "2024-02", 7),
    )
    found = op.cohorts(df, "k", "m", "v")
    assert rows(
        found, "k", "cohort_month", "months_since_first", "lifetime_revenue",
        "cohort_total_revenue", "cohort_revenue_percentage",
    ) == [
        ("a", "2024-01-01", 4, 3.0, 4.0, 75.0),
        ("b", "2024-01-01", 0, 1.0, 4.0, 25.0),
        ("c", "2024-02-01", 0, 7.0, 7.0, 100.0),
    ]
    retention = op.cohort_retention(df, "k", "m")
    assert rows(retention, "cohort_month", "months_since_first", "retention_pct") == [
        ("2024-01-01", 0, 100.0),
        ("2024-01-01", 4, 50.0),
        ("2024-02-01", 0, 100.0),
    ]


def walk_runs(days, follows):
    """Runs of a sorted list, found by walking over it."""
    found, run = [], []
    for day in days:
        if run and not follows(run[-1], day):
            found.append(run)
            run = []
        run.append(day)
    return found + [run]


@pytest.mark.parametrize("mode", ["activity", "growth"])
def test_day_streaks_equal_a_walk_over_the_days(spark, rows, mode):
    draw = random.Random(11)
    data, expected = [], []
    for key in range(30):
        days = sorted(draw.sample(range(200), 150 if key == 0 else draw.randrange(1, 60)))
        values = {day: draw.choice([1, 2, 3, 4, None]) for day in days}
        data += [(key, FIRST + timedelta(d), v) for d, v in values.items()]

        def follows(a, b):
            rose = None not in (values[a], values[b]) and values[b] > values[a]
            return b == a + 1 and (mode == "activity" or rose)

        for run in walk_runs(days, follows):
            length = len(run) - (mode == "growth")
            if length >= 1:
                ends = [(FIRST + timedelta(d)).isoformat() for d in (run[0], run[-1])]
                expected.append((key, *ends, length))
    df = spark.createDataFrame(data, "k int, d date, v int").repartition(5)
    assert rows(op.streaks(df, "k", "d", "v", mode=mode, unit="day")) == sorted(expected)


def test_gaps_equal_a_walk_over_the_days(spark, rows):
    draw = random.Random(12)
    data, expected = [], []
    for key in range(30):
        days = [draw.randrange(2000) for _ in range(500 if key == 0 else draw.randrange(1, 30))]
        data += [(key, FIRST + timedelta(d)) for d in days]
        steps = [b - a for a, b in zip(sorted(days), sorted(days)[1:]) if b - a >= 60]
        if steps:
            expected.append((key, max(steps), len(steps)))
    df = spark.createDataFrame(data, "k int, d date")
    assert rows(op.inactivity_gaps(df, "k", "d")) == sorted(expected)


def test_growth_streak_is_shorter_than_activity_streak(spark, folder):
    from grainline.catalog import QUERIES

    growth = QUERIES["longest_growth_streak"](spark, folder)
    activity = QUERIES["activity_streaks_by_month"](spark, folder)
    longest = activity.groupBy("customer_id").agg(F.max("streak_length").alias("active"))
    joined = growth.join(longest, "customer_id")
    assert joined.count() == growth.count() > 0
    assert joined.filter("longest_streak >= active").count() == 0
