"""Lookups between tables: matched, unmatched, attached, parent rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions._columns import Names, as_names


#: A key with more than one in so many rows of a full join's left side is hot.
HOT = 1000


def attach(left: DataFrame, right: DataFrame, on: Names, how: str = "inner") -> DataFrame:
    """Equi-join that keeps unmatched rows as ``how`` says: inner, left or full."""
    keys = as_names(on)
    if how in ("inner", "left"):
        return left.join(right, keys, how)
    if how != "full":
        raise ValueError(f"unknown join {how!r}")
    return _full(left, right, keys)


def _full(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """A full join in which a hot key of the left side is split over many tasks.

    Spark can't split a key of a full join.  Here a hot key's rows are dealt to
    salts by their content, each salt about as large as the limit of a hot key,
    and the right rows of that key go to all of them.  Such a key is in the left
    table by definition, so a copy that met no left row is no unmatched row.  Both
    tables are joined once; hot keys come from a count of the left keys, at most
    ``HOT`` of them.  Rows without a key match nothing and are spread.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = left.filter(known).groupBy(*keys).agg(F.count("*").alias("_n"))
    rows = left.agg(F.count("*")).scalar()
    salts = F.ceil(F.col("_n") * HOT / rows).cast("int")
    hot = F.broadcast(counts.filter(F.col("_n") * HOT > rows).select(*keys, salts.alias("_salts")))
    # Maps have no hash; the rest of a row tells its copies apart well enough.
    spread = F.xxhash64(*[F.col(f"`{c}`") for c, kind in left.dtypes if "map<" not in kind])
    salt = F.when(~known, F.pmod(spread, F.lit(HOT))).when(
        F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts"))
    )
    ours = left.join(hot, keys, "left").withColumn("_salt", F.coalesce(salt, F.lit(0)).cast("int"))
    ours = ours.drop("_salts").withColumn("_ours", F.lit(True))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    theirs = right.join(hot, keys, "left").withColumn("_hot", F.col("_salts").isNotNull())
    theirs = theirs.withColumn("_salt", copies).drop("_salts")
    joined = ours.join(theirs, [*keys, "_salt"], "full")
    spurious = F.col("_ours").isNull() & F.coalesce(F.col("_hot"), F.lit(False))
    return joined.filter(~spurious).drop("_salt", "_ours", "_hot")


def matched(left: DataFrame, right: DataFrame, on: Names) -> DataFrame:
    """Rows of ``left`` with at least one match."""
    keys = as_names(on)
    return left.join(right.select(*keys).distinct(), keys, "left_semi")


def never_matched(left: DataFrame, right: DataFrame, on: Names) -> DataFrame:
    """Rows of ``left`` without any match; rows without a key are kept."""
    keys = as_names(on)
    return left.join(right.select(*keys).distinct(), keys, "left_anti")


def hierarchy_parent(
    df: DataFrame, key: str, parent: str, name: str, out: str = "parent_name"
) -> DataFrame:
    """Add the name of each row's parent, NULL for roots and unknown parents."""
    parents = df.select(F.col(key).alias("_parent_key"), F.col(name).alias(out))
    return df.join(parents, F.col(parent) == F.col("_parent_key"), "left").drop("_parent_key")


def roots(df: DataFrame, parent: str) -> DataFrame:
    """Rows without a parent."""
    return df.filter(F.col(parent).isNull())


def by_key(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column equals a parameter."""
    return df.filter(F.col(column) == F.lit(value))
