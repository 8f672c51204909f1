"""Bits of a calendar, sessions, sketches and samples against plain forms."""

import random

import pytest
from plan_text import final_plan
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from grainline import operators as op
from grainline.catalog import QUERIES
from grainline.operators import sketches

SINCE = "2015-01-01"


@pytest.fixture
def activity(spark):
    """Days of activity over twenty years; a third of all rows on one entity."""
    draw = random.Random(3)
    data = []
    for _ in range(6000):
        key = "hot" if draw.random() < 0.33 else draw.choice([None, *(f"e{i}" for i in range(40))])
        # Most activity is in two years, so that runs and pauses of all lengths occur.
        day = draw.randrange(7670) if draw.random() < 0.2 else 3000 + draw.randrange(700)
        data.append((key, day))
    return spark.createDataFrame(data, "k string, n int").select(
        "k", F.date_add(F.lit(SINCE).cast("date"), F.col("n")).alias("d")
    )


def months(activity):
    return activity.select("k", F.trunc("d", "month").alias("m")).distinct()


def test_streaks_of_bits_equal_windows(activity, rows):
    bits = op.month_bits(activity, "k", "d", SINCE)
    plain = op.streaks(months(activity), "k", "m", mode="activity")
    found = op.streaks_of_bits(bits, "k", SINCE)
    assert rows(found) == rows(plain.select(found.columns)) != []
    found.collect()
    plan = final_plan(found)
    assert "Window" not in plan and plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("pause", [2, 3, 12])
def test_returns_of_bits_equal_windows(activity, rows, pause):
    bits = op.month_bits(activity, "k", "d", SINCE)
    plain = op.month_reactivations(months(activity), "k", "m", months=pause, extra=True)
    found = op.returns_of_bits(bits, "k", SINCE, months=pause)
    assert rows(found) == rows(plain.select(found.columns))


def test_retention_of_bits_equals_windows(activity, rows):
    bits = op.month_bits(activity, "k", "d", SINCE)
    plain = op.cohort_retention(months(activity), "k", "m")
    found = op.retention_of_bits(bits, SINCE)
    assert rows(found) == rows(plain.select(found.columns))


def test_calendar_edges(frame, rows):
    df = frame("k bigint; d date", (1, "2020-01-31"), (1, "2025-04-01"), (2, None), (3, "2020-01-01"))
    bits = op.month_bits(df, "k", "d", "2020-01-15", months=64)
    assert rows(op.streaks_of_bits(bits, "k", "2020-01-15")) == [
        (1, "2020-01-01", "2020-01-01", 1), (1, "2025-04-01", "2025-04-01", 1), (3, "2020-01-01", "2020-01-01", 1),
    ]
    assert rows(op.returns_of_bits(bits, "k", "2020-01-15")) == [(1, 2, 1, 1917), (3, 1, 0, None)]
    for day in ("2019-12-31", "2025-05-01"):
        late = frame("k bigint; d date", (1, day))
        with pytest.raises(PySparkException, match="outside of the calendar"):
            op.month_bits(late, "k", "d", "2020-01-15", months=64).collect()


def test_sessions_of_days_equal_windows(activity, rows):
    plain = op.streaks(activity.distinct(), "k", "d", mode="activity", unit="day")
    found = op.day_streaks(activity, "k", "d")
    assert rows(found) == rows(plain.select(found.columns))
    assert max(rows(found, "streak_length"))[0] > 10


def test_sessions_do_not_break_where_clocks_change(spark, frame, rows):
    df = frame("k bigint; d date", *((1, f"2024-{d}") for d in ("03-30", "03-31", "04-01", "10-26", "10-27", "10-28", "10-30")))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert rows(op.day_streaks(df, "k", "d"), "streak_length") == [(1,), (3,), (3,)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def values(spark, n=30_000):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 97 == 1, None).otherwise((F.col("id") % 11).cast("string")).alias("g"),
        F.when(F.col("id") % 13 > 0, (F.col("id") * 7919 % 10007).cast("decimal(12,2)") / 4).alias("v"),
    )


@pytest.mark.parametrize("levels", [(0.25, 0.5, 0.75), (0.0, 0.001, 1.0)])
def test_bracketed_quantiles_equal_plain_ones(spark, rows, levels):
    named = {f"q{i}": level for i, level in enumerate(levels)}
    df = values(spark)
    found = op.bracketed_quantiles(df, "g", "v", named)
    plain = df.groupBy("g").agg(*[F.percentile("v", F.lit(level)).alias(n) for n, level in named.items()])
    for other in (plain.select(found.columns), op.quantiles(df, "g", "v", named)):
        for one, two in zip(rows(found), rows(other), strict=True):
            assert one[0] == two[0] and one[1:] == pytest.approx(two[1:])


def test_brackets_of_few_equal_or_no_values(frame, rows):
    df = frame("g string; v decimal(12,2)", ("a", 1), ("a", 3), ("b", 2), ("b", 2), ("c", None))
    found = op.bracketed_quantiles(df, "g", "v", {"m": 0.5, "q": 0.25})
    assert rows(found) == [("a", 2.0, 1.5), ("b", 2.0, 2.0)]


def test_only_a_bracket_is_put_in_order(spark):
    df = spark.range(200_000).select(F.lit(1).alias("g"), (F.col("id") * 7919 % 200_003).cast("double").alias("v"))
    found = op.bracketed_quantiles(df, "g", "v", {"m": 0.5})
    assert found.first()["m"] == df.agg(F.percentile("v", F.lit(0.5))).first()[0]
    # Of 200,000 values about one in a hundred is counted by value.
    assert 2 * (sketches.ERROR * sketches.REACH + 2 / sketches.FEW) < 0.012


@pytest.mark.parametrize("size", [5, 1500])
def test_exact_samples_have_their_size_on_any_layout(spark, rows, size):
    df = spark.range(12_000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("s"), (F.col("id") % 10).alias("w"))
    sample = op.exact_sample(df, "s", "id", size)
    sizes = {r["s"]: r["count"] for r in sample.groupBy("s").count().collect()}
    whole = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    assert sizes == {s: min(n, size) for s, n in whole.items()}
    assert rows(op.exact_sample(df.repartition(7), "s", "id", size)) == rows(sample)
    drawn = op.exact_sample(df, "s", "id", size, weight="w")
    assert drawn.filter("w = 0").count() == 0
    assert drawn.agg(F.avg("w")).first()[0] > df.agg(F.avg("w")).first()[0]


def test_reconciled_ranges_equal_whole_tables(spark, rows):
    left = spark.range(30_000).select("id", (F.col("id") % 100).cast("decimal(12,2)").alias("v"))
    right = left.filter("id % 7001 <> 3").withColumn("v", F.when(F.col("id") % 6007 == 5, F.col("v") + 1).otherwise(F.col("v")))
    right = right.unionByName(spark.range(40_000, 40_002).select("id", F.lit(None).cast("decimal(12,2)").alias("v")))
    right = right.unionByName(spark.range(50_000, 50_001).select("id", F.lit(2).cast("decimal(12,2)").alias("v")))
    found = op.reconcile_by_range(left, right, "id", "v")
    assert rows(found) == rows(op.reconcile(left, right, "id", "v"))
    assert {r[0] for r in rows(found, "status")} == {"different", "only_left", "only_right"}
    assert op.reconcile_by_range(left, left, "id", "v").count() == 0
    # Few rows are moved besides the checksums.
    plan = final_plan(found)
    assert "LeftSemi" in plan


def test_violations_are_counted_while_writing(spark, tmp_path):
    df = spark.range(100).withColumn("v", F.when(F.col("id") % 10 > 0, F.col("id")))
    counts = op.write_checked(df, str(tmp_path / "t"), {"small": F.col("v") < 50, "even": F.col("id") % 2 == 0})
    assert counts == {"row_count": 100, "small": 45 + 10 - 0, "even": 50}
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100


def test_the_two_forms_of_a_query_are_equal(spark, folder, rows):
    for one, two in (
        ("activity_streaks_by_month", "activity_streaks_by_bits"),
        ("activity_streaks_by_day", "activity_streaks_by_session"),
        ("salary_quantiles", "salary_quantiles_by_sketch"),
    ):
        a, b = QUERIES[one](spark, folder), QUERIES[two](spark, folder)
        assert rows(a) == rows(b.select(a.columns)) != []
