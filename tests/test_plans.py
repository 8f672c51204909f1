"""What the physical plans must and must not contain."""

import re

import pytest
from plan_text import final_plan, plan_of

from grainline.catalog import QUERIES

REPORTS = sorted(n for n in QUERIES if n.startswith("report_"))


@pytest.fixture
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows(spark, folder, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "PythonUDF" not in plan and "EvalPython" not in plan


@pytest.mark.parametrize("name", REPORTS)
def test_reports_read_the_fact_once(spark, folder, no_broadcast, name):
    df = QUERIES[name](spark, folder)
    df.collect()
    fact = "l_extendedprice" if "attendance" not in name else "event_type"
    scans = [line for line in final_plan(df).splitlines() if "FileScan" in line and fact in line]
    # A report that keeps no row may end with an empty plan.
    assert len(scans) == 1 or (not scans and df.isEmpty())


def test_year_filter_and_columns_reach_the_scan(spark, folder):
    plan = plan_of(QUERIES["orders_in_year"](spark, folder).select("order_id"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(o_orderdate" in scan and "LessThan(o_orderdate" in scan
    assert "o_totalprice" not in scan and "o_custkey" not in scan


@pytest.mark.parametrize(
    "name", ["top_salaries_per_department", "latest_month", "dedupe_keep_latest", "report_top_products"]
)
def test_groups_are_cut_before_the_shuffle(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    assert plan.index("Final") < plan.index("hashpartitioning") < plan.index("Partial")


def test_streaks_need_one_shuffle_per_entity(spark, folder):
    months = QUERIES["active_months"](spark, folder)
    before = plan_of(months).count("Exchange")
    after = plan_of(QUERIES["activity_streaks_by_month"](spark, folder)).count("Exchange")
    assert after == before + 1


@pytest.mark.parametrize("name", ["cumulative_revenue", "cumulative_revenue_per_customer"])
def test_running_totals_window_over_folded_rows(spark, folder, no_broadcast, name):
    plan = plan_of(QUERIES[name](spark, folder))
    window = plan.index("Window [")
    assert "HashAggregate" in plan[window:]


def test_top_orders_keep_a_heap_per_task(spark, folder):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_orders"](spark, folder))


def scans_of(df, column):
    """Scans that read a column, in the plan that ran."""
    df.collect()
    return [x for x in final_plan(df).splitlines() if "FileScan" in x and column in x]


def test_reconciling_reads_each_side_once(spark, folder, no_broadcast):
    df = QUERIES["reconciled_order_totals"](spark, folder)
    assert len(scans_of(df, "o_totalprice")) == 1
    assert len(scans_of(df, "l_extendedprice")) == 1


def test_top_products_read_no_orders_and_shuffle_no_lines(spark, folder, no_broadcast):
    plan = plan_of(QUERIES["report_top_products"](spark, folder))
    assert "o_orderkey" not in plan and "hashpartitioning(l_orderkey" not in plan


@pytest.mark.parametrize(
    "name",
    ["report_product_dominance", "report_salesperson_performance", "yoy", "growth_streaks",
     "share_of_region"],
)
def test_lines_are_shuffled_once_and_folded_before_their_attributes(
    spark, folder, no_broadcast, name
):
    """Only the date needs raw lines; part and supplier meet the folded rows."""
    df = QUERIES[name](spark, folder)
    df.collect()
    plan = final_plan(df).splitlines()
    raw = [x for x in plan if " Exchange hashpartitioning(l_orderkey" in x]
    assert len(raw) <= 2  # of lines and of orders
    for i, line in enumerate(plan):
        if re.search(r" Exchange hashpartitioning\((l_partkey|l_suppkey)#\d+L, \d", line):
            below = plan[i + 1 : i + 5]
            assert not any("FileScan" in x and "l_extendedprice" in x for x in below)


def test_region_sales_are_folded_by_region_before_parts_are_joined(spark, folder):
    """A pair of seller and part is near unique, so folding by it would move every line."""
    df = QUERIES["top_products_per_region_with_ties"](spark, folder)
    df.collect()
    plan = final_plan(df)
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 1
    fold = plan.index("Exchange hashpartitioning(r_name")
    assert "l_partkey" in plan[fold:].splitlines()[0]
    assert plan.index("p_partkey") < fold and "hashpartitioning(l_suppkey" not in plan


def test_active_months_sum_nothing(spark, folder):
    assert "l_extendedprice" not in plan_of(QUERIES["active_months"](spark, folder))
