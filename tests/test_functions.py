from pyspark.sql import functions as F

from grainline import functions as f


def test_growth_has_no_value_without_a_base(frame, rows):
    df = frame("c decimal(18,2); p decimal(18,2)", (10, 0), (10, None), (15, 10), (2, 3))
    found = rows(df.select(f.growth_pct("c", "p").alias("g")))
    assert found == [(-33.33,), (50.0,), (None,), (None,)]


def test_percent_rounds_half_up(frame, rows):
    df = frame("a decimal(18,2); b decimal(18,2)", ("1.005", 100), ("1.015", 100))
    df = df.select(F.lit("0.125").cast("decimal(18,3)").alias("a"), F.lit(100).alias("b"))
    assert rows(df.select(f.percent("a", "b").alias("x")))[0] == (0.13,)


def test_growth_flag_needs_the_adjacent_month(frame, rows):
    df = frame(
        "m date; pm date; c decimal(18,2); p decimal(18,2)",
        ("2024-02", "2024-01", 2, 1),
        ("2024-03", "2024-01", 2, 1),
        ("2024-01", "2023-12", 2, 1),
        ("2024-02", "2024-01", 1, 1),
        ("2024-02", None, 1, None),
    )
    found = df.select(f.growth_flag("c", "p", "m", "pm").alias("g")).collect()
    assert [r.g for r in found] == [1, 0, 1, 0, 0]


def test_growth_from_zero_has_a_flag_but_no_percentage(frame, rows):
    df = frame("m date; pm date; c decimal(18,2); p decimal(18,2)", ("2024-02", "2024-01", 10, 0))
    found = df.select(f.growth_flag("c", "p", "m", "pm"), f.growth_pct("c", "p"))
    assert rows(found) == [(1, None)]


def test_month_arithmetic_crosses_the_year(frame, rows):
    df = frame("a date; b date", ("2023-11", "2024-02"))
    found = df.select(
        f.units_between("a", "b"),
        f.months_after("a", 3).cast("string"),
        f.months_before("b").cast("string"),
        f.next_day(F.lit("2023-12-31").cast("date")).cast("string"),
        f.days_between("a", "b"),
    )
    assert rows(found) == [(3, "2024-02-01", "2024-01-01", "2024-01-01", 92)]


def test_year_filter_is_half_open(frame, rows):
    df = frame("d date", ("2024-12-31",), ("2025-01-01",), ("2025-12-31",), ("2026-01-01",))
    assert rows(df.filter(f.in_year("d", 2025))) == [("2025-01-01",), ("2025-12-31",)]


def test_annual_salary_and_missing_values(frame, rows):
    df = frame("s decimal(12,2)", ("100.50",), (None,))
    assert rows(df.select(f.annual_salary("s"), f.or_zero("s"))) == [(1206.0, 100.5), (None, 0.0)]


def test_adjacent_days(frame, rows):
    df = frame("a date; b date", ("2024-02-29", "2024-03-01"), ("2024-02-28", "2024-03-01"))
    assert [r[0] for r in df.select(f.adjacent("a", "b", "day")).collect()] == [True, False]
