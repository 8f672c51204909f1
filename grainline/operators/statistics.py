"""Descriptive statistics, outliers, data checks, sampling and pivots.

Moments and regressions are partial aggregates.  Quantiles and modes are exact
and come from counts per distinct value, so no task collects a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from grainline.functions import total
from grainline.functions._columns import Names, as_names
from grainline.operators._joins import join_groups
from grainline.operators.ordering import cumulative
from grainline.operators.ranking import top_k_per_group


def moments(df: DataFrame, group: Names, value: str) -> DataFrame:
    """Count, mean and sample standard deviation per group."""
    number = F.col(value).cast("double")
    return df.groupBy(*as_names(group)).agg(
        F.count(value).alias("value_count"),
        F.avg(number).alias("mean_value"),
        F.stddev_samp(number).alias("stddev_value"),
    )


def quantiles(df: DataFrame, group: Names, value: str, levels: dict[str, float]) -> DataFrame:
    """Exact quantiles per group, interpolated between neighbours.

    ``levels`` maps output columns to levels between 0 and 1.
    """
    groups = as_names(group)
    present = df.filter(F.col(value).isNotNull())
    counts = present.groupBy(*groups, value).agg(F.count("*").alias("_n"))
    placed = cumulative(counts, value, "_n", groups, out="_upto", unique=True)
    sizes = placed.groupBy(*groups).agg(F.max("_upto").alias("_size"))
    placed = join_groups(placed, sizes, groups)
    number = F.col(value).cast("double")

    def at(position: Column) -> Column:
        inside = (F.col("_upto") - F.col("_n") <= position) & (position < F.col("_upto"))
        return F.max(F.when(inside, number))

    measures = []
    for out, level in levels.items():
        exact = (F.col("_size") - 1) * F.lit(float(level))
        low, high = F.floor(exact), F.ceil(exact)
        part = F.max(exact - low)
        measures.append((at(low) + (at(high) - at(low)) * part).alias(out))
    return placed.groupBy(*groups).agg(*measures)


def mode(df: DataFrame, group: Names, value: str) -> DataFrame:
    """Most frequent value per group; the smallest of equally frequent ones."""
    groups = as_names(group)
    present = df.filter(F.col(value).isNotNull())
    counts = present.groupBy(*groups, value).agg(F.count("*").alias("occurrences"))
    return top_k_per_group(counts, groups, "occurrences", 1, tie=value).drop("rnk")


def correlation(df: DataFrame, group: Names, y: str, x: str) -> DataFrame:
    """Correlation and least-squares line of ``y`` on ``x`` per group."""
    y_value, x_value = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*as_names(group)).agg(
        F.corr(y_value, x_value).alias("correlation"),
        F.regr_slope(y_value, x_value).alias("slope"),
        F.regr_intercept(y_value, x_value).alias("intercept"),
    )


def iqr_outliers(df: DataFrame, group: Names, value: str, reach: float = 1.5) -> DataFrame:
    """Rows further than ``reach`` interquartile ranges outside the quartiles."""
    quartiles = quantiles(df, group, value, {"_q1": 0.25, "_q3": 0.75})
    joined = join_groups(df, quartiles, group)
    number = F.col(value).cast("double")
    margin = (F.col("_q3") - F.col("_q1")) * reach
    outside = (number < F.col("_q1") - margin) | (number > F.col("_q3") + margin)
    return joined.filter(outside).drop("_q1", "_q3")


def z_scores(df: DataFrame, group: Names, value: str, out: str = "z_score") -> DataFrame:
    """Distance from the group mean in standard deviations."""
    groups = as_names(group)
    stats = moments(df, groups, value).select(*groups, "mean_value", "stddev_value")
    joined = join_groups(df, stats, groups)
    distance = F.col(value).cast("double") - F.col("mean_value")
    scored = joined.withColumn(out, distance / F.nullif("stddev_value", F.lit(0.0)))
    return scored.drop("mean_value", "stddev_value")


def write_checked(df: DataFrame, path: str, rules: dict[str, Column]) -> dict[str, int]:
    """Write ``df`` and count on the way how many rows break each rule.

    The counts are those of ``rule_violations``; they are metrics of the write,
    so the rows are computed and read once.  ``row_count`` is counted as well.
    """
    seen = Observation()
    broken = [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()
    ]
    df.observe(seen, F.count("*").alias("row_count"), *broken).write.parquet(path)
    return seen.get


def missing_values(df: DataFrame, columns: Names) -> DataFrame:
    """One row with the row count and the NULL count of each column."""
    nulls = [F.count_if(F.col(c).isNull()).alias(f"{c}_missing") for c in as_names(columns)]
    return df.agg(F.count("*").alias("row_count"), *nulls)


def rule_violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row with the number of rows that break each rule; NULL breaks it."""
    return df.agg(
        *[
            F.count_if(~F.coalesce(rule, F.lit(False))).alias(name)
            for name, rule in rules.items()
        ]
    )


def keyed_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    """The rows of about ``fraction`` of the keys, chosen by a hash of the key.

    The same keys are chosen on every run and in every table, however the rows
    are spread over files and tasks.
    """
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    drawn = F.conv(digest, 16, 10).cast("bigint") < int(fraction * (1 << 32))
    return df.filter(drawn)


def stratified_sample(
    df: DataFrame, stratum: str, key: str, fractions: dict[str, float]
) -> DataFrame:
    """``keyed_sample`` with a fraction of its own for each stratum; rows of a
    stratum that is not listed are left out.
    """
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    place = F.conv(digest, 16, 10).cast("bigint")
    bound = F.lit(0)
    for name, fraction in fractions.items():
        bound = F.when(F.col(stratum) == name, int(fraction * (1 << 32))).otherwise(bound)
    return df.filter(place < bound)


def pivot_sum(
    df: DataFrame,
    rows: Names,
    column: str,
    values: list[str],
    amount: str,
    other: str | None = None,
) -> DataFrame:
    """Sums with one output column per listed value of ``column``.

    Written as conditional sums: one partial aggregate, and the output schema
    does not depend on the data.  ``other`` names a column for all values that
    are not listed, NULL included.
    """
    sums = [total(F.when(F.col(column) == v, F.col(amount))).alias(v) for v in values]
    if other is not None:
        listed = F.coalesce(F.col(column).isin(*values), F.lit(False))
        sums.append(total(F.when(~listed, F.col(amount))).alias(other))
    return df.groupBy(*as_names(rows)).agg(*sums)


def lookup(
    df: DataFrame, reference: DataFrame, key: str, column: str, default: str
) -> DataFrame:
    """A column of the row with the same key, or a default where there is none."""
    found = df.join(reference.select(key, column), key, "left")
    return found.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def exact_sample(
    df: DataFrame, strata: Names, key: str, size: int, weight: str | None = None
) -> DataFrame:
    """``size`` rows of each stratum, or all if it has fewer, by the least marks.

    A row's mark is a hash of its key, so the sample doesn't depend on how rows
    are spread, and each task passes on at most ``size`` rows of a stratum.  With
    ``weight`` a row's chance grows with its weight: the mark is an exponential
    time whose rate the weight is; rows without a positive weight aren't drawn.
    """
    digest = F.substring(F.md5(F.col(key).cast("string")), 1, 8)
    place = F.conv(digest, 16, 10).cast("bigint")
    if weight is None:
        marked = df.withColumn("_mark", -place)
    else:
        uniform = (place + F.lit(0.5)) / F.lit(float(1 << 32))
        marked = df.filter(F.col(weight) > 0).withColumn("_mark", F.ln(uniform) / F.col(weight).cast("double"))
    return top_k_per_group(marked, strata, "_mark", size, tie=key, out="_place").drop("_mark", "_place")


def reconcile_by_range(
    left: DataFrame,
    right: DataFrame,
    key: Names,
    metric: str,
    left_name: str = "left",
    right_name: str = "right",
    ranges: int = 65_536,
) -> DataFrame:
    """``reconcile`` for tables that mostly agree: only ranges that differ are moved.

    Keys are dealt into a fixed number of ranges by a hash.  A checksum of each
    range, summed up in every task, tells which ranges differ; the rows of those
    alone are compared.
    """
    keys = as_names(key)
    kind = left.schema[metric].dataType

    def ranged(df: DataFrame) -> DataFrame:
        typed = df.select(*keys, F.col(metric).cast(kind).alias(metric))
        return typed.withColumn("_range", F.pmod(F.xxhash64(*keys), F.lit(ranges)).cast("int"))

    def sums(df: DataFrame, sign: int) -> DataFrame:
        content = F.xxhash64(*keys, metric).cast("decimal(38,0)")
        return df.groupBy("_range").agg(
            (F.sum(content) * sign).alias("_content"), (F.count("*") * sign).alias("_count")
        )

    ours, theirs = ranged(left), ranged(right)
    both = sums(ours, 1).unionByName(sums(theirs, -1)).groupBy("_range")
    differ = both.agg(F.sum("_content").alias("_content"), F.sum("_count").alias("_count"))
    differ = F.broadcast(differ.filter("_content <> 0 OR _count <> 0").select("_range"))
    ours, theirs = (df.join(differ, "_range", "left_semi").drop("_range") for df in (ours, theirs))
    return reconcile(ours, theirs, keys, metric, left_name, right_name)


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: Names,
    metric: str,
    left_name: str = "left",
    right_name: str = "right",
) -> DataFrame:
    """Keys on which two tables disagree about a metric, with the difference.

    Each table has one row per key.  Both are read once and meet in one
    aggregate; a key that is missing on one side counts like a NULL there.
    """
    keys = as_names(key)
    a, b = f"{left_name}_{metric}", f"{right_name}_{metric}"
    nothing = F.lit(None).cast(left.schema[metric].dataType)

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        empty = nothing.alias(other)
        return df.select(*keys, F.col(metric).alias(own), empty).select(*keys, a, b)

    both = side(left, a, b).unionByName(side(right, b, a))
    joined = both.groupBy(*keys).agg(F.max(a).alias(a), F.max(b).alias(b))
    ours, theirs = F.col(a), F.col(b)
    status = (
        F.when(ours.isNull(), f"only_{right_name}").when(theirs.isNull(), f"only_{left_name}")
        .otherwise("different")
    )
    zero = F.lit(0)
    return joined.filter(~ours.eqNullSafe(theirs)).withColumns(
        {"difference": F.coalesce(ours, zero) - F.coalesce(theirs, zero), "status": status}
    )
