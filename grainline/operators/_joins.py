"""Join helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.functions._columns import Names, as_names


def join_groups(df: DataFrame, groups: DataFrame, keys: Names, how: str = "inner") -> DataFrame:
    """Attach per-group values to the rows of ``df``; NULL is a group as well.

    No side is hinted here: the join is broadcast only when the size Spark measured
    allows it, and otherwise a large group is split by the skew handling.
    """
    keys = as_names(keys)
    renamed = groups.withColumnsRenamed({k: f"_group_{k}" for k in keys})
    matches = [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys]
    condition = reduce(lambda a, b: a & b, matches)
    return df.join(renamed, condition, how).drop(*[f"_group_{k}" for k in keys])
