"""Exact quantiles by way of a mergeable sketch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.functions._columns import Names, as_names
from grainline.operators._joins import join_groups
from grainline.operators.ordering import cumulative

#: Size of a sketch, and the error of its ranks (fitted by the sketch's authors).
SIZE = 4096
ERROR = 2.296 / SIZE**0.9021
#: A bracket reaches so many errors to both sides.
REACH = 3
#: A group with fewer values has no bracket.
FEW = 1000


def bracketed_quantiles(
    df: DataFrame, group: Names, value: str, levels: dict[str, float]
) -> DataFrame:
    """Exact quantiles per group, equal to those of ``quantiles``.

    The first scan makes a sketch of each group, merged from those of the tasks.
    It gives two values around each quantile.  The second scan counts the values
    below the bracket and keeps those inside, about one in a hundred for each
    level, and only these are counted by value and put in order.  If a quantile
    were not in its bracket, which three times the sketch's error rules out in
    practice, the query would fail instead of being wrong.
    """
    groups = as_names(group)
    number = F.col(value).cast("double")
    present = df.filter(F.col(value).isNotNull()).select(*groups, number.alias("_number"))
    sketched = present.groupBy(*groups).agg(
        F.kll_sketch_agg_double("_number", F.lit(SIZE)).alias("_sketch"), F.count("*").alias("_size")
    )

    # A position lies between two values; a group of a few values is all bracket.
    margin = ERROR * REACH + 2 / FEW

    def end(level: float, outermost: float) -> Column:
        at = [min(max(x, 0.0), 1.0) for x in (level, outermost)]
        near, far = (F.kll_sketch_get_quantile_double("_sketch", F.lit(x)) for x in at)
        return F.when(F.col("_size") < FEW, far).otherwise(near)

    ends = [
        F.struct(
            F.lit(out).alias("_out"),
            F.lit(float(level)).alias("_level"),
            end(level - margin, 0.0).alias("_low"),
            end(level + margin, 1.0).alias("_high"),
        )
        for out, level in levels.items()
    ]
    brackets = sketched.select(*groups, "_size", F.inline(F.array(*ends)))
    inside = join_groups(present, brackets, groups).filter(F.col("_number") <= F.col("_high"))
    # All that is below a bracket is one value before it.
    below = F.when(F.col("_number") < F.col("_low"), F.lit(float("-inf"))).otherwise(F.col("_number"))
    by = [*groups, "_out"]
    counts = inside.groupBy(*by, "_size", "_level", below.alias("_v")).agg(F.count("*").alias("_n"))
    placed = cumulative(counts, "_v", "_n", by, out="_upto", unique=True)

    def at(position: Column) -> Column:
        here = (F.col("_upto") - F.col("_n") <= position) & (position < F.col("_upto"))
        return F.max(F.when(here, F.col("_v")))

    exact = (F.col("_size") - 1) * F.col("_level")
    found = placed.groupBy(*by).agg(
        at(F.floor(exact)).alias("_a"), at(F.ceil(exact)).alias("_b"), F.max(exact - F.floor(exact)).alias("_part")
    )
    missed = F.col("_a").isNull() | F.col("_b").isNull() | (F.col("_a") == float("-inf"))
    result = F.when(missed, F.raise_error(F.lit("a quantile is outside of its bracket")).cast("double"))
    result = result.otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_part"))
    named = found.select(*groups, "_out", result.alias("_result"))
    return named.groupBy(*groups).agg(
        *[F.max(F.when(F.col("_out") == out, F.col("_result"))).alias(out) for out in levels]
    )
