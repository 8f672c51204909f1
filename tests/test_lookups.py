"""Joins, duplicates, hierarchies, balances, storage and data checks."""

import os
import random

import pytest
from pyspark.sql import functions as F

from plan_text import final_plan

from grainline import operators as op
from grainline import sources as src
from grainline.operators import lookups


@pytest.fixture
def people(frame):
    return frame("id bigint; dept bigint", (1, 10), (2, 20), (3, None))


@pytest.fixture
def units(frame):
    return frame("dept bigint; name string", (10, "ten"), (30, "thirty"))


def test_unmatched_rows_on_both_sides(people, units, rows):
    assert rows(op.attach(people, units, "dept"), "id", "name") == [(1, "ten")]
    assert rows(op.attach(people, units, "dept", "left"), "id", "name") == [
        (1, "ten"), (2, None), (3, None),
    ]
    assert rows(op.attach(people, units, "dept", "full"), "id", "name") == [
        (1, "ten"), (2, None), (3, None), (None, "thirty"),
    ]
    assert rows(op.matched(people, units, "dept"), "id") == [(1,)]
    assert rows(op.never_matched(people, units, "dept"), "id") == [(2,), (3,)]


@pytest.mark.parametrize("how", ["inner", "left", "full"])
def test_attach_equals_a_plain_join(spark, rows, how):
    draw = random.Random(3)

    def side(name, n, low, high):
        keys = [draw.choice([None, 1, draw.randrange(low, high)]) for _ in range(n)]
        return spark.createDataFrame(list(zip(keys, range(n))), f"k int, {name} int")

    left, right = side("a", 200, 0, 60), side("b", 40, 30, 90)
    found = op.attach(left, right, "k", how)
    assert found.columns == ["k", "a", "b"]
    assert rows(found) == rows(left.join(right, "k", how))


def test_totals_below_equal_a_recursion(spark, rows):
    draw = random.Random(2)
    # A chain of a thousand, a bushy tree with a hot root, lone rows, an unknown parent.
    up = {i: i - 1 if i else None for i in range(1000)}
    up |= {2000: None} | {2000 + i: draw.choice([2000, 2000, draw.randrange(2000, 2000 + i)]) for i in range(1, 600)}
    up |= {5000: None, 5001: 9999}
    pay = {i: draw.choice([None, draw.randrange(100)]) for i in up}
    expected = {i: [0, 0] for i in up}
    for i in up:
        at = i
        while at in up:
            expected[at][0] += 1
            expected[at][1] += pay[i] or 0
            at = up[at]
    df = spark.createDataFrame([(i, up[i], pay[i]) for i in up], "id bigint, up bigint, v int")
    assert rows(op.hierarchy_totals(df, "id", "up", "v")) == sorted((i, n, float(t)) for i, (n, t) in expected.items())
    assert rows(op.hierarchy_totals(df.limit(0), "id", "up", "v")) == []
    cycle = spark.createDataFrame([(1, 2, 1), (2, 1, 1), (3, None, 1)], "id bigint, up bigint, v int")
    with pytest.raises(ValueError, match="cycle"):
        op.hierarchy_totals(cycle, "id", "up", "v")


def test_a_full_join_splits_a_hot_key(spark, rows, monkeypatch):
    monkeypatch.setattr(lookups, "HOT", 20)
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 17 == 1, None).otherwise(F.col("id") % 400).cast("int").alias("k"),
        (F.col("id") % 1000).alias("a"),
    )
    right = spark.range(500).select(
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 100 == 9, 7).otherwise(F.col("id") + 200).cast("int").alias("k"),
        F.col("id").alias("b"),
    )
    found = op.attach(left, right, "k", "full")
    assert found.columns == ["k", "a", "b"]
    assert rows(found) == rows(left.join(right, "k", "full"))
    plan = final_plan(found)
    # Both tables are joined once; keys that are hot are counted besides.
    assert plan.count("FullOuter") == 1
    nothing = left.limit(0)
    assert rows(op.attach(nothing, right, "k", "full")) == rows(nothing.join(right, "k", "full"))
    assert rows(op.attach(left, right.limit(0), "k", "full")) == rows(left.join(right.limit(0), "k", "full"))


def test_only_changed_months_are_written(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(900).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 90).cast("int")).alias("d"))

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "t").glob("sales_month=*/*.parquet")}

    assert len(src.refresh_months(df, "d", path)) == 3
    first = files()
    assert src.refresh_months(df.repartition(5), "d", path) == []
    assert files() == first
    more = df.unionByName(spark.range(1).select((F.col("id") - 1).alias("id"), F.lit("2024-02-10").cast("date").alias("d")))
    assert [str(m) for m in src.refresh_months(more, "d", path)] == ["2024-02-01"]
    kept = {f: t for f, t in files().items() if "2024-02" not in str(f)}
    assert kept == {f: t for f, t in first.items() if "2024-02" not in str(f)}
    assert rows(src.read_months(spark, path, "d", "2024-01-01", "2025-01-01"), "id", "d") == rows(more, "id", "d")
    # Months that are gone are removed; rows without a date have a place of their own.
    fewer = more.filter("d < '2024-03-01'").unionByName(spark.range(1).select("id", F.lit(None).cast("date").alias("d")))
    assert [str(m) for m in src.refresh_months(fewer, "d", path)] == ["2024-03-01", "None"]
    assert rows(src.read_months(spark, path, "d", "2024-01-01", "2025-01-01"), "id") == rows(more.filter("d < '2024-03-01'"), "id")


def test_duplicates_and_latest(frame, rows):
    df = frame(
        "id bigint; name string; s decimal(12,2); d date",
        (1, "a", 1, "2024-01-01"),
        (2, "a", 1, "2024-02-01"),
        (3, "a", 1, "2024-02-01"),
        (4, "b", None, "2024-01-01"),
        (5, "b", None, "2024-01-02"),
        (6, "c", 1, "2024-01-01"),
    )
    assert rows(op.duplicates(df, ["name", "s"])) == [("a", 1.0, 3), ("b", None, 2)]
    kept = op.dedupe_keep_latest(df, ["name", "s"], "d", tie="id")
    assert rows(kept, "id") == [(2,), (5,), (6,)]
    assert kept.columns == df.columns


def test_set_operators(frame, rows):
    a = frame("x int", (1,), (1,), (2,), (None,))
    b = frame("x int", (1,), (3,), (None,), (None,))
    assert rows(op.union_distinct(a, b)) == [(1,), (2,), (3,), (None,)]
    assert len(rows(op.union_all(a, b))) == 8
    assert rows(op.in_both(a, b)) == [(1,), (None,)]
    assert rows(op.only_left(a, b)) == [(2,)]
    assert rows(op.in_both(a, b, keep_copies=True)) == [(1,), (None,)]
    assert rows(op.only_left(a, b, keep_copies=True)) == [(1,), (2,)]


def test_parents_and_chains(frame, rows):
    df = frame(
        "id bigint; up bigint; name string",
        (1, None, "a"), (2, 1, "b"), (3, 2, "c"), (4, 3, "d"), (5, 4, "e"), (6, None, "f"), (7, 99, "g"),
    )
    assert rows(op.hierarchy_parent(df, "id", "up", "name"), "name", "parent_name")[1] == ("b", "a")
    assert rows(op.roots(df, "up"), "id") == [(1,), (6,)]
    assert rows(op.hierarchy_levels(df, "id", "up")) == [
        (1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 1, 3), (5, 1, 4), (6, 6, 0), (7, 99, 1),
    ]


@pytest.mark.parametrize("length", [1, 2, 3])
def test_a_cycle_is_reported(frame, length):
    cycle = [(i, (i + 1) % length) for i in range(length)]
    chain = [(100, None), (101, 100), (102, 101), (200, 0)]
    df = frame("id bigint; up bigint", *cycle, *chain)
    with pytest.raises(ValueError, match="cycle"):
        op.hierarchy_levels(df, "id", "up")


def test_a_long_chain_arrives(spark, rows):
    df = spark.range(1000).select("id", F.when(F.col("id") > 0, F.col("id") - 1).alias("up"))
    assert rows(op.hierarchy_levels(df, "id", "up")) == [(i, 0, i) for i in range(1000)]


def test_adjustments_conserve_the_total(frame, rows):
    balances = frame("account_id bigint; balance decimal(28,2)", (1, 1000), (2, 50), (3, 7))
    pairs = frame("a bigint; b bigint; v decimal(18,2)", (1, 2, 500), (1, 2, 1))
    after = op.apply_adjustments(balances, op.transfers(pairs, "a", "b", "v"))
    assert rows(after) == [(1, 499.0), (2, 551.0), (3, 7.0)]
    assert rows(after.agg(F.sum("balance"))) == rows(balances.agg(F.sum("balance")))
    assert rows(balances)[0] == (1, 1000.0)


def test_movements_of_an_unknown_account_are_kept(frame, rows):
    balances = frame("account_id bigint; owner string; balance decimal(28,2)", (1, "a", 10))
    pairs = frame("a bigint; b bigint; v decimal(18,2)", (1, 9, 10))
    after = op.apply_adjustments(balances, op.transfers(pairs, "a", "b", "v"))
    assert rows(after) == [(1, "a", 0.0), (9, None, 10.0)]


def test_parameters_are_bound_not_pasted(spark, frame, rows):
    df = frame("id bigint; name string", (1, "x"), (2, "x' OR '1'='1"))
    text = "SELECT id FROM {people} WHERE name = :name"
    assert rows(op.run_statement(spark, text, {"people": df}, name="x")) == [(1,)]
    assert rows(op.run_statement(spark, text, {"people": df}, name="x' OR '1'='1")) == [(2,)]
    assert rows(op.by_key(df, "id", 2), "id") == [(2,)]


def test_monthly_storage_reads_only_its_months(spark, frame, rows, tmp_path):
    df = frame(
        "id int; d date; v decimal(12,2)",
        *[(i, f"2024-{1 + i % 4:02}-{1 + i % 28:02}", i) for i in range(60)],
    )
    path = str(tmp_path / "sales")
    src.write_by_month(df, "d", path)
    assert sorted(p for p in os.listdir(path) if p.startswith("sales_month")) == [
        f"sales_month=2024-0{m}-01" for m in range(1, 5)
    ]
    found = src.read_months(spark, path, "d", "2024-02-10", "2024-03-05")
    inside = df.filter("d >= '2024-02-10' AND d < '2024-03-05'")
    assert rows(found) == rows(inside) != []
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sales_month" in plan


def test_missing_values_and_rules(frame, rows):
    df = frame("a int; b int", (1, None), (None, None), (3, 4))
    assert rows(op.missing_values(df, ["a", "b"])) == [(3, 1, 2)]
    assert rows(op.rule_violations(df, {"a_small": F.col("a") < 2, "b_set": F.col("b").isNotNull()})) == [
        (2, 2)
    ]


def test_statistics_on_a_few_rows(frame, rows):
    df = frame("g string; v decimal(12,2)", *[("a", v) for v in (1, 2, 2, 3, 100, None)], ("b", 5))
    levels = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    assert rows(op.quantiles(df, "g", "v", levels)) == [("a", 2.0, 2.0, 3.0), ("b", 5.0, 5.0, 5.0)]
    assert rows(op.mode(df, "g", "v")) == [("a", 2.0, 2), ("b", 5.0, 1)]
    assert rows(op.iqr_outliers(df, "g", "v")) == [("a", 100.0)]
    assert rows(op.z_scores(df, "g", "v").filter("g = 'b'"), "z_score") == [(None,)]


def test_reconcile_lists_only_disagreements(frame, rows):
    a = frame("k string; v decimal(18,2)", ("same", 1), ("diff", 5), ("mine", 2), ("null", None))
    b = frame("k string; v decimal(18,2)", ("same", 1), ("diff", 3), ("yours", 4), ("null", None))
    assert rows(op.reconcile(a, b, "k", "v"), "k", "difference", "status") == [
        ("diff", 2.0, "different"), ("mine", 2.0, "only_left"), ("yours", -4.0, "only_right"),
    ]


def test_keyed_sample_is_stable_and_about_right(spark, rows):
    df = spark.range(20000).withColumnRenamed("id", "k")
    once = rows(op.keyed_sample(df, "k", 0.1))
    again = rows(op.keyed_sample(df.repartition(7), "k", 0.1))
    assert once == again and 1800 < len(once) < 2200


def test_strata_have_their_own_fractions(spark, rows):
    df = spark.range(20000).select(F.col("id").alias("k"), (F.col("id") % 3).cast("string").alias("s"))
    drawn = op.stratified_sample(df, "s", "k", {"0": 0.5, "1": 0.0})
    counts = dict(rows(drawn.groupBy("s").count()))
    assert set(counts) == {"0"} and 3100 < counts["0"] < 3600
    assert rows(drawn) == rows(op.stratified_sample(df.repartition(5), "s", "k", {"0": 0.5, "1": 0.0}))


def test_segments_and_churn(frame, rows):
    df = frame("k string; v int", ("a", 5), ("b", 10), ("c", 20), ("d", None))
    assert rows(op.with_segment(df, "v", {"mid": 10, "top": 20}, "low"), "k", "segment") == [
        ("a", "low"), ("b", "mid"), ("c", "top"), ("d", "low"),
    ]
    fact = frame("k string; d date", ("a", "2024-01-01"), ("b", "2024-03-01"), ("a", "2025-01-01"))
    assert rows(op.churned(fact, "k", "d", "2024-03-31", 60), "k", "idle_days") == [("a", 90)]


def test_pivot_and_lookup(frame, rows):
    df = frame("r string; c string; v decimal(18,2)", ("x", "a", 1), ("x", "a", 2), ("x", "b", 5), ("y", "z", 9))
    assert rows(op.pivot_sum(df, "r", "c", ["a", "b"], "v")) == [("x", 3.0, 5.0), ("y", None, None)]
    rest = op.pivot_sum(df, "r", "c", ["a"], "v", other="rest")
    assert rows(rest) == [("x", 3.0, 5.0), ("y", None, 9.0)]
    ref = frame("c string; label string", ("a", "A"))
    assert rows(op.lookup(df, ref, "c", "label", "?"), "v", "label") == [
        (1.0, "A"), (2.0, "A"), (5.0, "?"), (9.0, "?"),
    ]


def test_conversion(frame, rows):
    df = frame("u int; s string", (1, "view"), (1, "buy"), (2, "view"), (3, "buy"), (4, "other"))
    assert rows(op.conversion_rate(df, "u", "s", "view", "buy")) == [(2, 1, 50.0)]
