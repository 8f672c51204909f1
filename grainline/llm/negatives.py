"""Hard negatives by exact inner products from tables of subset sums.

The components of an anchor are taken in groups of eight; a table holds the sum
of each of a group's 256 subsets.  A candidate is packed into bit planes: byte g
of plane p has bit p of the eight components of group g.  Such a byte is an index
into the table of group g, so a score is looked up plane by plane, each sum
shifted by its plane, and the sign plane taken off.

Candidates are dealt into groups of bounded size, and blocks of anchors stream
through every group: once for the local best positives, and once more for the
local best negatives in the bands that the positives set.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from grainline.llm.common import stored
from grainline.llm.topk import as_integers, matrix

SCALE, EVERY = 256, 100
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least so many hundredths of the positive's.
LEAST = 80
#: Candidates held by a task, on average, and anchors scored at once.
GROUP, BLOCK = 32_768, 64
#: Candidates whose scores are built up at once.
ROWS = 1024

PACKED = "vec_id long, label long, packed binary"
RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def planes_for(least: int, most: int) -> int:
    """Bits of a two's complement that holds both."""
    return max(int(most).bit_length(), int(~least).bit_length() if least < 0 else 0) + 1


def packed(ints: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of rows of integers: rows by planes by groups of eight."""
    bits = [np.packbits((ints >> p & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(planes)]
    return np.stack(bits, axis=1)


def subset_sums(anchors: np.ndarray, groups: int, kind: type) -> np.ndarray:
    """Sums of all subsets of each group of eight: groups by subsets by anchors."""
    wide = np.zeros((len(anchors), groups * 8), np.int64)
    wide[:, : anchors.shape[1]] = anchors
    parts = wide.reshape(len(anchors), groups, 8)
    out = np.zeros((groups, 256, len(anchors)), kind)
    for j in range(8):
        out[:, 1 << j : 2 << j] = out[:, : 1 << j] + parts[:, :, j].T[:, None, :]
    return out


def scores(bits: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact inner products of packed candidates and anchors: candidates by anchors."""
    n, planes, groups = bits.shape
    # No partial sum exceeds the anchor's absolute sum shifted by all planes.
    bound = int(np.abs(anchors).sum(axis=1).max(initial=0)) << planes
    kind = np.int32 if bound < 2**31 else np.int64
    table = subset_sums(anchors, groups, kind)
    out = np.empty((n, len(anchors)), np.int64)
    for start in range(0, n, ROWS):
        piece = bits[start : start + ROWS]
        held = np.zeros((len(piece), len(anchors)), kind)
        found = np.empty_like(held)
        for p in reversed(range(planes)):
            held += held
            for g in range(groups):
                np.take(table[g], piece[:, p, g], axis=0, out=found, mode="clip")
                if p == planes - 1:
                    held -= found
                else:
                    held += found
        out[start : start + ROWS] = held
    return out


def first(of: np.ndarray, usable: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest usable entries, the earlier ones of ties."""
    at = np.flatnonzero(usable)
    if len(at) > k:
        values = of[at]
        at = at[values >= np.partition(values, len(at) - k)[len(at) - k]]
    return at[np.argsort(-of[at], kind="stable")][:k]


def _pack(width: int, planes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits = packed(matrix(batch.column(2), width), planes)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in bits], pa.binary())],
            ["vec_id", "label", "packed"],
        )


class _Group:
    """Candidates of one group, in the order of their ids."""

    def __init__(self, rows: list[tuple], planes: int):
        self.ids = np.array([r[0] for r in rows], np.int64)
        self.labels = np.array([r[1] for r in rows], np.int64)
        self.bits = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), planes, -1)


def _positives(group: _Group, block: list[dict], score: np.ndarray, k: int) -> Iterator[tuple]:
    for a, anchor in enumerate(block):
        of = score[:, a]
        same = (group.labels == anchor["label"]) & (group.ids != anchor["vec_id"])
        for i in first(of, same, k):
            yield anchor["vec_id"], int(group.ids[i]), int(of[i])


def _negatives(group: _Group, block: list[dict], score: np.ndarray, k: int, least: int) -> Iterator[tuple]:
    for a, anchor in enumerate(block):
        of = score[:, a]
        other = group.labels != anchor["label"]
        for positive in anchor["positives"]:
            high = positive["score"]
            near = other & (of <= high) & (of * 100 >= high * least)
            for i in first(of, near, k):
                yield anchor["vec_id"], positive["vec_id"], high, int(group.ids[i]), int(of[i])


def _mined(planes: int, width: int, find, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What `find` yields for each group of candidates and each block of anchors.

    Rows come by group, its candidates before the blocks.
    """
    now, held, group = None, [], None
    for batch in batches:
        number, vec_id, label, bits, block = (c.to_pylist() for c in batch.columns)
        for row in zip(number, vec_id, label, bits, block, strict=True):
            if row[0] != now:
                now, held, group = row[0], [], None
            if row[4] is None:
                held.append(row[1:4])
                continue
            if not held:
                continue
            group = group or _Group(held, planes)
            anchors = np.zeros((len(row[4]), width), np.int64)
            for i, anchor in enumerate(row[4]):
                anchors[i, : len(anchor["ints"])] = anchor["ints"]
            found = list(find(group, row[4], scores(group.bits, anchors)))
            if found:
                columns = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)


def _through(candidates: DataFrame, anchors: DataFrame, groups: int, run, names: list[str]) -> DataFrame:
    """Every block of `anchors` against every group of candidates, in one job."""
    blocks = max(-(-anchors.count() // BLOCK), 1)
    held = anchors.groupBy(F.pmod(F.xxhash64("vec_id"), F.lit(blocks))).agg(
        F.collect_list(F.struct("vec_id", "label", "ints", "positives")).alias("block")
    )
    kind = held.schema["block"].dataType
    rows = candidates.select("number", "vec_id", "label", "packed", F.lit(None).cast(kind).alias("block"))
    nothing = F.lit(None)
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    dealt = held.select(
        every.alias("number"),
        nothing.cast("long").alias("vec_id"),
        nothing.cast("long").alias("label"),
        nothing.cast("binary").alias("packed"),
        "block",
    )
    both = rows.union(dealt).repartitionByRange(groups, "number")
    both = both.sortWithinPartitions("number", F.col("vec_id").asc_nulls_last())
    return both.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def mine(
    vectors: DataFrame,
    label: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    every: int = EVERY,
    scale: int = SCALE,
) -> DataFrame:
    """The hardest negatives of each anchor and positive.

    Anchors are the rows whose vec_id is divisible by `every`.  An anchor's
    positives are the `positives` other rows of its label with the highest
    scores; a positive's negatives are the `negatives` rows of other labels with
    the highest scores that are at most the positive's and at least `least`
    hundredths of it.  Scores are exact inner products of floor(`scale` * x)
    while they stay below 2^56; ties go to the smaller vec_id.

    Rows without vec_id or label, with a null vector or with a null or
    non-finite component take no part.  Of several rows with one vec_id the one
    with the least label, then vector, counts.  Components that one of two
    vectors lacks count as zero.  Without anchors, positives or negatives there
    are no rows.  Labels are integers, by default those of the column `label`.
    """
    label = F.col("label") if label is None else label
    named = vectors.select("vec_id", "embedding", label.cast("long").alias("label"))
    whole = as_integers(named.where("label is not null"), scale, "label")
    rows = stored(
        whole.groupBy("vec_id").agg(F.min(F.struct("label", "ints")).alias("row")).select("vec_id", "row.*")
    )
    is_anchor = F.col("vec_id") % every == 0
    of = rows.agg(
        F.count("*"), F.max(F.size("ints")), F.min(F.array_min("ints")), F.max(F.array_max("ints"))
    ).first()
    n, width, low, high = of[0], of[1] or 1, of[2] or 0, of[3] or 0
    spark = vectors.sparkSession
    groups = max(-(-n // GROUP), spark.sparkContext.defaultParallelism)
    planes = planes_for(low, high)
    number = F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")
    candidates = stored(
        rows.select("vec_id", "label", "ints").mapInArrow(partial(_pack, width, planes), PACKED).withColumn("number", number)
    )
    anchors = rows.where(is_anchor)
    none = F.array().cast("array<struct<vec_id:bigint,score:bigint>>")
    names = ["anchor_id", "vec_id", "score"]
    run = partial(_mined, planes, width, partial(_positives, k=positives), names)
    local = _through(candidates, anchors.withColumn("positives", none), groups, run, names)
    best = W.partitionBy("anchor_id").orderBy(F.col("score").desc(), "vec_id")
    chosen = local.withColumn("at", F.row_number().over(best)).where(F.col("at") <= positives)
    chosen = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("vec_id", "score")).alias("positives"))
    known = stored(anchors.join(chosen, F.col("vec_id") == F.col("anchor_id")).drop("anchor_id"))

    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
    run = partial(_mined, planes, width, partial(_negatives, k=negatives, least=least), names)
    local = _through(candidates, known, groups, run, names)
    best = W.partitionBy("anchor_id", "positive_id").orderBy(F.col("negative_score").desc(), "negative_id")
    return (
        local.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= negatives)
        .select(*(c.split()[0] for c in RESULT.split(", ")))
    )


def shifted_label(divisor: int = 7, classes: int = 10) -> Column:
    """label, the next one in rows whose vec_id is divisible by `divisor`."""
    return F.when(F.col("vec_id") % divisor == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
