from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from grainline import operators as op
from grainline import sources as src
from grainline.catalog import QUERIES


def test_a_table_comes_from_the_catalog_or_from_files(spark, folder, frame, rows):
    frame("a int", (1,)).createOrReplaceTempView("named")
    assert rows(src.table(spark, None, "named")) == [(1,)]
    assert src.table(spark, folder, "nation").count() == 25


def test_a_table_that_was_written_again_has_its_new_columns(spark, tmp_path):
    path = f"{tmp_path}/t.parquet"
    spark.range(3).write.parquet(path)
    assert src.table(spark, str(tmp_path), "t").columns == ["id"]
    spark.range(3).selectExpr("id", "id AS more").write.mode("overwrite").parquet(path)
    assert src.table(spark, str(tmp_path), "t").columns == ["id", "more"]


def test_every_line_has_an_order_a_part_and_a_supplier(spark, folder):
    lines = src.table(spark, folder, "lineitem")
    for key, name, other in (
        ("l_orderkey", "orders", "o_orderkey"),
        ("l_partkey", "part", "p_partkey"),
        ("l_suppkey", "supplier", "s_suppkey"),
    ):
        heads = src.table(spark, folder, name)
        assert lines.join(heads, F.col(key) == F.col(other), "left_anti").isEmpty()
        assert heads.groupBy(other).count().filter("count > 1").isEmpty()


def test_all_sales_facts_agree(spark, folder, rows):
    months = ["year(order_date)", "month(order_date)"]

    def by_month(df):
        return rows(df.groupBy(*map(F.expr, months)).agg(F.sum("sales_amount")))

    expected = by_month(src.order_sales(spark, folder))
    assert by_month(src.product_sales(spark, folder)) == expected
    assert by_month(src.seller_sales(spark, folder)) == expected
    whole = rows(src.order_sales(spark, folder).agg(F.sum("sales_amount")))
    assert rows(src.product_sales(spark, folder, dated=False).agg(F.sum("sales_amount"))) == whole
    assert rows(src.region_sales(spark, folder).agg(F.sum("sales_amount"))) == whole


def retail(frame, folder, price, n=1):
    """A small set of tables with ``n`` lines of one price."""
    write = lambda df, name: df.write.parquet(f"{folder}/{name}.parquet")
    lines = frame("l_orderkey bigint; l_partkey bigint; l_suppkey bigint", (1, 1, 1)).crossJoin(
        frame("l_linenumber int", *[(i,) for i in range(n)])
    )
    write(lines.withColumn("l_extendedprice", F.lit(price).cast("double")), "lineitem")
    orders = frame("o_orderkey bigint; o_custkey bigint", (1, 1))
    write(orders.withColumn("o_orderdate", F.lit("1999-05-05").cast("timestamp_ntz")), "orders")
    write(frame("p_partkey bigint; p_brand string; p_type string", (1, "b", "t")), "part")
    write(frame("s_suppkey bigint; s_nationkey int", (1, 2)), "supplier")


@pytest.mark.parametrize("price, n", [(5_000_000, 1), (9_000_000_000_000, 1200)])
def test_large_lines_and_sums_are_exact(spark, frame, tmp_path, price, n):
    retail(frame, tmp_path, price, n)
    whole = Decimal(price) * n
    assert src.order_sales(spark, str(tmp_path)).first()["sales_amount"] == whole
    months = op.period_revenue(src.product_sales(spark, str(tmp_path)), "product_id")
    assert months.first()["monthly_revenue"] == whole
    years = op.rollup_years(
        op.period_revenue(src.seller_sales(spark, str(tmp_path)), "salesperson_id"), "salesperson_id"
    )
    assert years.first()["yearly_revenue"] == whole


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_an_amount_that_does_not_fit_is_an_error(spark, frame, tmp_path, ansi):
    retail(frame, tmp_path, 1e17)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="does not fit"):
            src.order_sales(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_product_without_brand_is_unknown(spark, frame, rows, tmp_path):
    write = lambda df, name: df.write.parquet(f"{tmp_path}/{name}.parquet")
    write(frame("p_partkey bigint; p_brand string; p_type string", (1, None, "x"), (2, "x", None)), "part")
    assert rows(src.dim_products(spark, str(tmp_path)), "product_id") == [(None,), (None,)]


def test_views_keep_their_types(spark, folder):
    types = dict(src.employees(spark, folder).dtypes)
    assert types["salary"] == "decimal(12,2)" and types["join_date"] == "date"
    assert dict(src.orders(spark, folder).dtypes)["order_date"] == "date"
    months = QUERIES["period_revenue"](spark, folder)
    assert dict(months.dtypes)["sales_month"] == "date"
    assert dict(months.dtypes)["monthly_revenue"] == "decimal(28,2)"
