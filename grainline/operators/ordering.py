"""Numbering and running sums over one global order.

A window without partition keys sends every row to one task.  Here rows are cut
into ranges of the order itself, each range is handled on its own, and one small
row per range carries what came before it.

Ranges are cut on two levels.  A sample of fixed size gives the bounds of 1,024
slices; a sample of a fixed share of the rows cuts each slice into parts.  Bounds
are data, an array that every row searches in ten steps, so the plan doesn't grow
with their number, and nothing runs before the result is asked for.  What is
carried is summed first over the parts of a slice, then over the slices, so no
window over it is longer than 1,024 rows.  A row's range depends on the row
alone: a task that is run again gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grainline.functions import TOTAL, total
from grainline.functions._columns import Names, as_names
from grainline.operators._joins import join_groups

#: Slices of the order, and parts of a slice, at most.
SLICES = 1024
#: Rows of a sample for each range.
DRAWN = 32
#: One of so many rows is drawn to cut a slice: a part has about a million rows.
EVERY = 32_768

RANGE = ["_slice", "_part"]


def sort_columns(order: list[str]) -> list[Column]:
    """Sort order of column names; ``-`` in front is descending, NULL comes last."""
    return [
        F.col(name[1:]).desc_nulls_last() if name.startswith("-") else F.col(name).asc_nulls_last()
        for name in order
    ]


def _ascending(df: DataFrame, order: list[str]) -> Column:
    """A struct that sorts ascending as ``order`` does."""
    schema, fields = df.schema, []
    for i, name in enumerate(order):
        column = F.col(name.removeprefix("-"))
        kind = schema[name.removeprefix("-")].dataType
        value = _reversed(column, kind) if name.startswith("-") else column
        fields += [column.isNull().alias(f"n{i}"), value.alias(f"v{i}")]
    return F.struct(*fields)


def _reversed(column: Column, kind: T.DataType) -> Column:
    """A value that ascends where the column descends."""
    if isinstance(kind, T.IntegralType):
        return F.bitwise_not(column)
    if isinstance(kind, T.DecimalType):
        return -column
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # NaN is the greatest number, so it comes first.
        return F.struct((~F.isnan(column)).alias("f"), F.when(~F.isnan(column), -column).alias("v"))
    if isinstance(kind, T.DateType):
        return -F.unix_date(column)
    if isinstance(kind, T.TimestampType):
        return -F.unix_micros(column)
    if isinstance(kind, T.BooleanType):
        return ~column
    if isinstance(kind, T.StringType):
        # Complemented digits of the bytes; the end comes after every digit.
        digits = F.translate(F.hex(column), "0123456789ABCDEF", "FEDCBA9876543210")
        return F.concat(digits, F.lit("G"))
    raise TypeError(f"{kind.simpleString()} columns can't be descending")


def _bounds(parts: Column) -> Column:
    """Keys that cut the sorted sample ``_drawn`` into so many equal pieces."""
    size = F.size("_drawn")
    cut = lambda i: F.get(F.col("_drawn"), F.floor(size * i / parts).cast("int"))
    inner = F.transform(F.sequence(F.lit(1), parts - 1), cut)
    return F.when((parts > 1) & (size > 0), inner).otherwise(F.slice(F.col("_drawn"), 1, 0))


def _place(bounds: str) -> Column:
    """Number of bounds up to the row's key, found by halving steps; never NULL."""
    steps = F.array(*[F.lit(SLICES >> i) for i in range(1, SLICES.bit_length())])

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(F.col(bounds), at + width - 1) <= F.col("_k"), at + width).otherwise(at)

    return F.coalesce(F.aggregate(steps, F.lit(0), step), F.lit(0))


def sliced(df: DataFrame, order: list[str], **more: Column) -> DataFrame:
    """Add the range a row belongs to, ``_slice`` and ``_part``, and columns ``more``.

    Samples hold the rows with certain hashes.  The whole order makes up a bound,
    so a value that fills many ranges, NULL included, is cut by the columns
    after it.
    """
    key, columns = _ascending(df, order), [F.col(f"`{c}`") for c in df.columns]
    hashed = F.xxhash64("_k")
    drawn = df.select(key.alias("_k")).orderBy(hashed, "_k").limit(SLICES * DRAWN)
    drawn = drawn.agg(F.sort_array(F.collect_list("_k")).alias("_drawn"))
    first = drawn.select(_bounds(F.least(F.lit(SLICES), F.size("_drawn")))).scalar()
    keyed = df.select(*columns, key.alias("_k"), first.alias("_first"))
    in_slices = keyed.select(*columns, "_k", _place("_first").alias("_slice"))

    some = in_slices.filter(F.pmod(hashed, F.lit(EVERY)) == 0).groupBy(F.col("_slice").alias("_of"))
    some = some.agg(F.sort_array(F.collect_list("_k")).alias("_drawn"))
    parts = F.least(F.lit(SLICES), F.floor(F.size("_drawn") / DRAWN).cast("int"))
    finer = some.select("_of", _bounds(F.greatest(parts, F.lit(1))).alias("_second"))
    # One row per slice, each with fewer than 1,024 bounds.
    placed = in_slices.join(F.broadcast(finer), F.col("_slice") == F.col("_of"), "left")
    part = F.when(F.col("_of").isNull(), 0).otherwise(_place("_second"))
    return placed.select(*columns, "_slice", part.alias("_part"), *[c.alias(n) for n, c in more.items()])


def _all_before(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(W.unboundedPreceding, -1)


#: What is carried: an aggregate, a column, and how to put together what the slices
#: before give and what the parts before in the same slice give; either may be NULL.
Carried = tuple[Callable[[str], Column], str, Callable[[Column, Column], Column]]


def carry(ranges: DataFrame, keys: list[str], columns: dict[str, Carried]) -> DataFrame:
    """Fold columns over the ranges before each one, for each key.

    The ranges of a slice are one row while slices are summed up, so nothing is
    joined, and no window is longer than a slice has parts or than there are slices.
    """
    parts = [c for c in ranges.columns if c not in (*keys, "_slice")]
    folds = [fold(c).alias(f"_all_{out}") for out, (fold, c, _) in columns.items()]
    slices = ranges.groupBy(*keys, "_slice").agg(F.collect_list(F.struct(*parts)).alias("_ranges"), *folds)
    before = _all_before(W.partitionBy(*keys).orderBy("_slice"))
    above = [fold(f"_all_{out}").over(before).alias(f"_above_{out}") for out, (fold, _, _) in columns.items()]
    flat = slices.select(*keys, "_slice", "_ranges", *above)
    flat = flat.select(*keys, "_slice", *[f"_above_{out}" for out in columns], F.inline("_ranges"))
    inside = _all_before(W.partitionBy(*keys, "_slice").orderBy("_part"))
    carried = [
        join(F.col(f"_above_{out}"), fold(c).over(inside)).alias(out) for out, (fold, c, join) in columns.items()
    ]
    return flat.select(*keys, "_slice", *parts, *carried)


def _added(above: Column, inside: Column) -> Column:
    return F.when(above.isNull(), inside).otherwise(above + F.coalesce(inside, F.lit(0)))


def _total_before(column: str) -> Carried:
    return F.sum, column, _added


def positions(
    df: DataFrame,
    group: Names,
    order: list[str],
    out: str,
    weight: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One more than the rows before in the group's order, or than their ``weight``.

    ``order`` ends in a column that is unique in its group.  With ``limit`` only
    rows at positions up to it stay, and ranges that start beyond are not sorted:
    a task holds one range of a group, whatever the limit.
    """
    groups = as_names(group)
    ranged = sliced(df, [*groups, *order])
    count = F.lit(1) if weight is None else F.col(weight)
    sizes = ranged.groupBy(*groups, *RANGE).agg(F.sum(count.cast("long")).alias("_size"))
    starts = carry(sizes, groups, {"_start": _total_before("_size")})
    starts = starts.select(*groups, *RANGE, F.coalesce("_start", F.lit(0)).alias("_start"))
    window = W.partitionBy(*groups, *RANGE).orderBy(*sort_columns(order))
    if limit is not None:
        starts = starts.filter(F.col("_start") < limit)
        ranged = _joined(ranged, starts, groups)
    before = F.coalesce(F.sum(count.cast("long")).over(_all_before(window)), F.lit(0))
    inside = F.row_number().over(window) - 1 if weight is None else before
    placed = ranged.withColumn("_inside", inside)
    if limit is None:
        placed = _joined(placed, starts, groups)
    position = F.col("_start") + F.col("_inside") + 1
    placed = placed.select(*[F.col(f"`{c}`") for c in df.columns if c != out], position.alias(out))
    return placed if limit is None else placed.filter(F.col(out) <= limit)


def _joined(rows: DataFrame, ranges: DataFrame, groups: list[str], how: str = "inner") -> DataFrame:
    """Attach what belongs to a row's range."""
    same = [*groups, *RANGE]
    renamed = ranges.select(*[F.col(f"`{c}`").alias(f"_of{c}" if c in same else c) for c in ranges.columns])
    matches = [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in groups]
    matches += [F.col(c) == F.col(f"_of{c}") for c in RANGE]
    found = rows.join(renamed, reduce(lambda a, b: a & b, matches), how)
    return found.drop(*[f"_of{c}" for c in [*groups, *RANGE]])


def global_row_number(df: DataFrame, order: list[str], out: str = "row_num") -> DataFrame:
    """``ROW_NUMBER`` over all rows; ``order`` has to end in a unique column."""
    return positions(df, [], order, out)


def group_row_number(
    df: DataFrame, group: Names, order: list[str], out: str = "row_num"
) -> DataFrame:
    """``ROW_NUMBER`` inside each group without gathering a group in one task."""
    return positions(df, group, order, out)


def compare_ranks(
    df: DataFrame,
    value: str,
    key: str,
    row_number: str = "row_num",
    rank: str = "rnk",
    dense_rank: str = "dense_rnk",
) -> DataFrame:
    """``ROW_NUMBER``, ``RANK`` and ``DENSE_RANK`` side by side, highest first.

    NULL values come last and share one rank.  ``key`` is unique and orders
    tied rows.  All three come from the same ranges.  A range passes on how many
    rows and distinct values it has, its last value and where that value began;
    a value that began in an earlier range keeps its ranks.
    """
    ranged = sliced(df, [f"-{value}", key], _v=_ascending(df, [f"-{value}"]))
    values = ranged.groupBy(*RANGE, "_v").agg(F.count("*").alias("_n"))
    ranges = values.groupBy(*RANGE).agg(
        F.sum("_n").alias("_size"),
        F.count("*").alias("_values"),
        F.min("_v").alias("_lowest"),
        F.max("_v").alias("_last"),
        F.max_by("_n", "_v").alias("_of_last"),
    )
    last = F.max, "_last", lambda above, inside: F.coalesce(inside, above)
    ranges = carry(ranges, [], {"_start": _total_before("_size"), "_before": last})
    start = F.coalesce("_start", F.lit(0))
    goes_on = F.col("_before").isNotNull() & F.col("_before").eqNullSafe(F.col("_lowest"))
    # Where the range's last value begins, if it does so here.
    began = F.when(~(goes_on & (F.col("_values") == 1)), start + F.col("_size") - F.col("_of_last"))
    ranges = ranges.select(
        *RANGE,
        start.alias("_start"),
        goes_on.alias("_goes_on"),
        (F.col("_values") - goes_on.cast("int")).alias("_new"),
        began.alias("_began"),
    )
    ranges = carry(ranges, [], {"_dense": _total_before("_new"), "_rank": (F.max, "_began", F.greatest)})
    ranges = ranges.select(*RANGE, "_start", "_goes_on", F.coalesce("_dense", F.lit(0)).alias("_dense"), "_rank")

    inside = W.partitionBy(*RANGE)
    by_value = inside.orderBy(F.col(value).desc_nulls_last())
    by_row = inside.orderBy(F.col(value).desc_nulls_last(), F.col(key).asc_nulls_last())
    numbered = ranged.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *RANGE,
        F.row_number().over(by_row).alias("_row_in"),
        F.rank().over(by_value).alias("_rank_in"),
        F.dense_rank().over(by_value).alias("_dense_in"),
    )
    earlier = F.col("_goes_on") & (F.col("_dense_in") == 1)
    ranks = {
        row_number: F.col("_start") + F.col("_row_in"),
        rank: F.when(earlier, F.col("_rank") + 1).otherwise(F.col("_start") + F.col("_rank_in")),
        dense_rank: F.col("_dense") + F.col("_dense_in") - F.col("_goes_on").cast("int"),
    }
    kept = [F.col(f"`{c}`") for c in df.columns if c not in ranks]
    return _joined(numbered, ranges, []).select(*kept, *[c.alias(n) for n, c in ranks.items()])


def cumulative(
    df: DataFrame,
    order: str,
    value: str,
    key: Names | None = None,
    out: str = "cumulative",
    unique: bool = False,
) -> DataFrame:
    """Running total in ``order``, per ``key`` or over everything.

    Rows that tie on ``order`` share one total, so the sum runs over one row
    per key and order value, which is joined back to the rows.  Dates are few
    per key by the calendar.  Any other order column may be different in every
    row; that goes through ranges, which split a large key too.
    ``unique`` says that no two rows of a key tie, and saves the joining back.
    """
    keys = as_names(key)
    if unique:
        return _ranged_running_sum(df, keys, order, value, out)
    steps = df.groupBy(*keys, order).agg(total(value).alias("_step"))
    if isinstance(df.schema[order].dataType, T.DateType):
        running = _up_to_here(W.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last()))
        sums = steps.withColumn(out, F.sum("_step").over(running).cast(TOTAL))
    else:
        sums = _ranged_running_sum(steps, keys, order, "_step", out)
    return join_groups(df, sums.drop("_step"), [*keys, order])


def _up_to_here(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(W.unboundedPreceding, W.currentRow)


def _ranged_running_sum(
    df: DataFrame, keys: list[str], order: str, value: str, out: str
) -> DataFrame:
    """Running total of rows that are unique by key and order.

    Ranges are those of (key, order): a key that does not fit into one goes on
    in the next.  So at most one key per range has anything carried into it.
    """
    ranged = sliced(df, [*keys, order])
    sums = ranged.groupBy(*keys, *RANGE).agg(F.sum(value).alias("_sum"))
    carried = carry(sums, keys, {"_carried": _total_before("_sum")}).drop("_sum")
    carried = carried.filter(F.col("_carried").isNotNull())
    inside = _up_to_here(W.partitionBy(*keys, *RANGE).orderBy(*sort_columns([order])))
    found = _joined(ranged.withColumn("_inside", F.sum(value).over(inside)), carried, keys, "left")
    return found.withColumn(out, _added(F.col("_carried"), F.col("_inside")).cast(TOTAL)).drop(
        *RANGE, "_inside", "_carried"
    )
