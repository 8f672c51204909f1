"""Ranks, top-k, n-th highest, running totals, shares and averages."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plan_text import plan_of

from grainline import operators as op
from grainline.operators import ordering

SALARIES = "id bigint; dept string; s decimal(12,2)"


@pytest.fixture
def staff(frame):
    return frame(
        SALARIES,
        (1, "x", 100),
        (2, "x", 100),
        (3, "y", 90),
        (4, "y", 80),
        (5, "z", None),
    )


def test_nth_highest(frame, staff, rows):
    assert rows(op.nth_highest(staff, "s", 3)) == [(80.0,)]
    assert rows(op.rows_at_nth_highest(staff, "s", 1), "id") == [(1,), (2,)]


def test_nth_highest_that_does_not_exist(frame, rows):
    two = frame(SALARIES, (1, "x", 100), (2, "x", 90), (3, "x", 90))
    assert rows(op.nth_highest(two, "s", 3)) == [(None,)]
    assert rows(op.rows_at_nth_highest(two, "s", 3)) == []


def test_compare_ranks_puts_unknown_last(staff, rows):
    assert rows(op.compare_ranks(staff, "s", "id"), "id", "row_num", "rnk", "dense_rnk") == [
        (1, 1, 1, 1),
        (2, 2, 1, 1),
        (3, 3, 3, 2),
        (4, 4, 4, 3),
        (5, 5, 5, 4),
    ]


def test_top_k_methods(staff, rows):
    by_row = op.top_k_per_group(staff, "dept", "s", 1, tie="id")
    assert rows(by_row, "id") == [(1,), (3,), (5,)]
    tied = op.top_k_per_group(staff, "dept", "s", 1, method="dense_rank")
    assert rows(tied, "id", "rnk") == [(1, 1), (2, 1), (3, 1), (5, 1)]
    assert rows(op.top_k(staff, "s", 2, tie="id"), "id") == [(1,), (2,)]


def hot_rows(spark, seed=5, n=4000):
    """A third of all rows in one group, many equal values, some unknown."""
    draw = random.Random(seed)
    data = []
    for i in range(n):
        group = "hot" if draw.random() < 0.4 else f"g{draw.randrange(20)}"
        value = None if draw.random() < 0.05 else draw.randrange(30)
        data.append((i, group, value))
    df = spark.createDataFrame(data, "id bigint, g string, v int")
    return data, df.withColumn("v", F.col("v").cast("decimal(12,2)"))


@pytest.mark.parametrize("method", ["row_number", "rank", "dense_rank"])
@pytest.mark.parametrize("k", [3, 1000, 1001, 5000])
def test_top_k_equals_a_plain_window(spark, rows, method, k):
    _, df = hot_rows(spark)
    order = [F.col("v").desc_nulls_last()] + ([F.col("id")] if method == "row_number" else [])
    window = W.partitionBy("g").orderBy(*order)
    plain = df.withColumn("rnk", getattr(F, method)().over(window)).filter(F.col("rnk") <= k)
    few = op.top_k_per_group(df, "g", "v", k, method=method, tie="id", few_ties=True)
    assert rows(few, "id", "g", "rnk") == rows(plain, "id", "g", "rnk")
    found = op.top_k_per_group(df, "g", "v", k, method=method, tie="id")
    assert rows(found, "id", "g", "rnk") == rows(plain, "id", "g", "rnk")
    assert found.schema["rnk"].dataType == plain.schema["rnk"].dataType


@pytest.fixture(params=["one level", "two levels"])
def ranges(request, monkeypatch):
    """Ranges as they are, and many small ones on both levels."""
    if request.param == "two levels":
        monkeypatch.setattr(ordering, "SLICES", 8)
        monkeypatch.setattr(ordering, "DRAWN", 3)
        monkeypatch.setattr(ordering, "EVERY", 5)


@pytest.mark.parametrize("method", ["row_number", "rank", "dense_rank"])
@pytest.mark.parametrize("k", [1001, 20000])
def test_a_large_k_sorts_ranges_of_a_group(spark, rows, method, k, ranges):
    df = spark.range(40000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 7).cast("string")).alias("g"),
        F.when(F.col("id") % 50 > 0, F.col("id") % 15000).alias("v"),
        "id",
    )
    tie = ["id"] if method == "row_number" else []
    window = W.partitionBy("g").orderBy(F.col("v").desc_nulls_last(), *tie)
    plain = df.withColumn("rnk", getattr(F, method)().over(window)).filter(F.col("rnk") <= k)
    found = op.top_k_per_group(df, "g", "v", k, method=method, tie=tie)
    assert rows(found, "id", "g", "rnk") == rows(plain, "id", "g", "rnk")
    assert all("_part" in line for line in plan_of(found).splitlines() if "row_number" in line)


def test_ranges_beyond_the_limit_are_not_sorted(spark, monkeypatch):
    monkeypatch.setattr(ordering, "SLICES", 64)
    df = spark.range(64_000).select(F.lit(1).alias("g"), F.col("id").alias("v"))
    found = op.top_k_per_group(df, "g", "v", 1500)
    assert found.count() == 1500
    # The rows reach the window through the join with the ranges that start in time.
    plan = plan_of(found)
    assert "Join" in plan[plan.index("Window [") :]


def test_ranks_equal_plain_windows(spark, rows, ranges):
    _, df = hot_rows(spark)
    by_value = W.orderBy(F.col("v").desc_nulls_last())
    plain = df.withColumns(
        {
            "row_num": F.row_number().over(W.orderBy(F.col("v").desc_nulls_last(), "id")),
            "rnk": F.rank().over(by_value),
            "dense_rnk": F.dense_rank().over(by_value),
        }
    )
    columns = ["id", "row_num", "rnk", "dense_rnk"]
    assert rows(op.compare_ranks(df, "v", "id"), *columns) == rows(plain, *columns)


@pytest.mark.parametrize("key", [None, "g"])
@pytest.mark.parametrize("order", ["id", "step", "day"])
def test_running_totals_equal_a_plain_window(spark, rows, key, order, ranges):
    _, df = hot_rows(spark)
    df = df.withColumns(
        {
            "step": F.when(F.col("id") % 11 == 0, None).otherwise(F.col("id") % 97),
            "day": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 40).cast("int")),
        }
    )
    window = W.partitionBy(*([key] if key else [])).orderBy(F.col(order).asc_nulls_last())
    plain = df.withColumn("total", F.sum("v").over(window))
    found = op.cumulative(df, order, "v", key, out="total")
    assert rows(found, "id", "total") == rows(plain, "id", "total")


@pytest.mark.parametrize("key", [None, "g"])
def test_unique_running_totals_equal_a_plain_window(spark, rows, key, ranges):
    _, df = hot_rows(spark)
    window = W.partitionBy(*([key] if key else [])).orderBy("id")
    plain = df.withColumn("total", F.sum("v").over(window))
    found = op.cumulative(df, "id", "v", key, out="total", unique=True)
    assert rows(found, "id", "total") == rows(plain, "id", "total")
    assert set(found.columns) == {"id", "g", "v", "total"}


def test_running_total_of_unknown_values_starts_unknown(frame, rows):
    df = frame("id bigint; v decimal(12,2)", (1, None), (2, 3), (3, None))
    assert rows(op.cumulative(df, "id", "v", out="t"), "id", "t") == [(1, None), (2, 3.0), (3, 3.0)]


def test_same_day_rows_share_one_running_total(frame, rows):
    df = frame("d date; v decimal(12,2)", ("2024-01-01", 1), ("2024-01-01", 2), ("2024-01-02", 4))
    assert rows(op.cumulative(df, "d", "v", out="t"), "v", "t") == [(1.0, 3.0), (2.0, 3.0), (4.0, 7.0)]


def test_last_running_total_is_the_sum(spark, rows):
    data, df = hot_rows(spark)
    sums = defaultdict(int)
    for _, group, value in data:
        sums[group] += value or 0
    last = op.cumulative(df, "id", "v", "g", out="t").groupBy("g").agg(F.max("t"))
    assert rows(last) == sorted((g, float(t)) for g, t in sums.items())


def test_shares_add_up(spark, rows):
    _, df = hot_rows(spark)
    entities = df.filter("v > 0")
    shares = op.share_of_group(entities, "g", "v", out="share")
    for _, total, n in rows(shares.groupBy("g").agg(F.sum("share"), F.count("*"))):
        assert abs(total - 100) <= 0.005 * n


def test_share_of_a_group_without_name_or_value(frame, rows):
    df = frame(SALARIES, (1, None, 30), (2, None, 10), (3, "x", 0))
    assert rows(op.share_of_group(df, "dept", "s"), "id", "share_pct") == [
        (1, 75.0), (2, 25.0), (3, None),
    ]


def test_above_averages(frame, staff, rows):
    assert rows(op.above_average(staff, "s"), "id") == [(1,), (2,)]  # average 92.5
    assert rows(op.above_group_average(staff, "s", "dept"), "id") == [(3,)]
    nobody = frame(SALARIES, (1, "x", None), (2, "x", None))
    assert rows(op.above_group_average(nobody, "s", "dept")) == []
    third = frame(SALARIES, (1, "x", "0.01"), (2, "x", "0.01"), (3, "x", "0.02"))
    assert rows(op.above_average(third, "s"), "id") == [(3,)]


def test_peers_of_two_top_departments(frame, rows):
    df = frame(SALARIES, (1, "a", 9), (2, "a", 9), (3, "a", 1), (4, "b", 9), (5, "c", 1))
    assert rows(op.peers_of_max(df, "dept", "s"), "id") == [(1,), (2,), (3,), (4,)]


def test_percent_of_total(staff, rows):
    assert rows(op.percent_of_total(staff, "dept")) == [("x", 2, 40.0), ("y", 2, 40.0), ("z", 1, 20.0)]


def test_average_filter_ignores_unknown_and_drops_empty_groups(staff, rows):
    found = op.groups_where_average(staff, "dept", "s", above=85, out="a")
    assert rows(found) == [("x", 100.0)]
