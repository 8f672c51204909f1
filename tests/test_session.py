"""Row numbers depend on the rows alone, and nothing is left behind."""

import glob
import os
import tempfile

import pytest
from plan_text import plan_of
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline import operators as op
from grainline.catalog import QUERIES
from grainline.operators import ordering


def test_row_numbers_do_not_change_between_uses(spark, rows):
    df = spark.range(5000).withColumn("v", F.col("id") % 7).repartition(9)
    numbered = op.global_row_number(df, ["-v", "id"])
    assert rows(numbered) == rows(numbered)
    assert [r[0] for r in rows(numbered, "row_num")] == list(range(1, 5001))
    again = op.global_row_number(df.repartition(3), ["-v", "id"])
    assert rows(again) == rows(numbered)


def test_ranges_cut_a_value_that_fills_the_table(spark, rows, monkeypatch):
    monkeypatch.setattr(ordering, "EVERY", 4)
    monkeypatch.setattr(ordering, "DRAWN", 2)
    monkeypatch.setattr(ordering, "SLICES", 16)
    df = spark.range(20000).select(F.lit(None).cast("int").alias("v"), "id")
    ranges = ordering.sliced(df, ["v", "id"]).groupBy("_slice", "_part").count()
    sizes = [n for (n,) in rows(ranges, "count")]
    assert sum(sizes) == 20000 and 200 < len(sizes) <= 256 and max(sizes) < 1500
    slices = [n for (n,) in rows(ranges.groupBy("_slice").count(), "count")]
    assert len(slices) == 16 and max(slices) <= 16


def test_the_plan_does_not_grow_with_the_number_of_partitions(spark, folder):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    found = set()
    try:
        for n in (8, 200, 2000):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            ranked = QUERIES["compare_ranks"](spark, folder)
            assert len(plan_of(ranked)) < 100_000
            found.add(tuple(sorted(map(tuple, ranked.collect()))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found) == 1


@pytest.mark.parametrize(
    "order", ["-s", "s", "-n", "-d", "-t", "-b", "-x"], ids=["-string", "string", "-number", "-date", "-time", "-bool", "-double"]
)
def test_order_equals_a_sort(spark, rows, order):
    df = spark.range(300).selectExpr(
        "id", "if(id % 9 = 0, null, substr(conv(id * 7919 % 4001, 10, 16), 1, int(id % 4))) AS s",
        "if(id % 9 = 1, null, if(id = 7, -9223372036854775807L - 1, id * 31 % 17 - 8)) AS n", "date_add(date'2024-01-01', int(id * 13 % 29)) AS d",
        "timestamp_seconds(id * 17 % 23) AS t", "id % 3 = 0 AS b", "if(id % 5 = 0, double('NaN'), id * 0.5 % 7) AS x",
    )
    found = op.global_row_number(df, [order, "id"])
    window = W.orderBy(*ordering.sort_columns([order, "id"]))
    plain = df.withColumn("row_num", F.row_number().over(window))
    assert rows(found, "id", "row_num") == rows(plain, "id", "row_num")


def test_what_has_no_order_backwards_is_refused(spark):
    with pytest.raises(TypeError):
        op.global_row_number(spark.createDataFrame([([1],)], "s array<int>"), ["-s"])


@pytest.mark.parametrize(
    "name",
    ["compare_ranks", "cumulative_revenue_by_order", "department_running_total",
     "salary_quantiles", "order_amount_outliers", "management_levels", "partitioned_sales"],
)
def test_no_folder_appears_in_the_temporary_folder(spark, folder, name):
    mine = os.path.join(tempfile.gettempdir(), "grainline-*")
    before = set(glob.glob(mine))
    QUERIES[name](spark, folder).collect()
    assert set(glob.glob(mine)) == before
