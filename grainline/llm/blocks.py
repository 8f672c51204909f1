"""Classes of similar documents from buckets, compared in blocks.

Documents that may be similar share a bucket.  Comparing is done in tasks that
hold a block of documents at once, and what leaves a task is a spanning forest of
the links found in it, at most one row for each document, so a large group of
copies makes no table of pairs.

Every document joins the group of the least document that it shares a bucket with.
A group is cut into blocks; each block, its group's first document included, is
compared within.  Where a bucket then still holds documents of several classes,
the blocks these are in are compared with each other.  A block is compared in two
steps: a short sketch of each document tells which of them may have a partner
there, and only their texts are moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.llm import repeats
from grainline.llm.common import stored, texts_of
from grainline.llm.components import components

#: Documents and symbols (shingles, say) of a block, on average.
BLOCK, SYMBOLS = 256, 1_000_000

#: Given sketches and the number of the class that each document is in: which
#: documents may be similar to one of another class.
Screen = Callable[[list[bytes], np.ndarray], np.ndarray]
#: Given texts, sketches and classes: places of similar documents of different
#: classes, in pairs, as far as they join classes that weren't joined yet.
Compare = Callable[[list[bytes], list[bytes], np.ndarray], Iterator[tuple[int, int]]]

_PAIR = "a struct<d:bigint,h:bigint>, b struct<d:bigint,h:bigint>"


class Forest:
    """Disjoint sets; `join` tells whether two were apart."""

    def __init__(self, sets: np.ndarray):
        first: dict[int, int] = {}
        self.up = [first.setdefault(int(c), i) for i, c in enumerate(sets)]

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def spanning(linked: np.ndarray, classes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links of a square table that join all that it links, each of them needed."""
    forest = Forest(classes)
    unseen = np.ones(len(linked), bool)
    for start in range(len(linked)):
        todo = [start] if unseen[start] else []
        unseen[start] = False
        while todo:
            i = todo.pop()
            near = np.flatnonzero(linked[i] & unseen)
            unseen[near] = False
            for j in near.tolist():
                todo.append(j)
                if forest.join(i, j):
                    yield i, j


def row_of(d: str = "d", h: str = "h") -> Column:
    """A row's identity, ordered by doc_id."""
    return F.struct(F.col(d).alias("d"), F.col(h).alias("h"))


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[tuple, tuple]]]:
    """Blocks with several documents, (d, h) to the rest of their row, by key."""
    now, held = None, {}
    for batch in batches:
        key, d, h, label = (batch.column(i).to_pylist() for i in range(4))
        rest = [texts_of(c) for c in batch.columns[4:]]
        for k, d_, h_, *more in zip(key, d, h, label, *rest, strict=True):
            if k != now:
                if len(held) > 1:
                    yield now, held
                now, held = k, {}
            held[d_, h_] = tuple(more)
    if len(held) > 1:
        yield now, held


def _classes(held: dict[tuple, tuple]) -> np.ndarray:
    return np.unique([r[0] for r in held.values()], return_inverse=True)[1]


def _screened(screen: Screen, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The documents of each block that may have a partner in it."""
    for key, held in _by_block(batches):
        ends, classes = list(held), _classes(held)
        at = np.flatnonzero(screen([r[1] for r in held.values()], classes))
        labels = [r[0] for r in held.values()]
        columns = [[key] * len(at), [ends[i][0] for i in at], [ends[i][1] for i in at], [labels[i] for i in at]]
        sketches = [r[1] for r in held.values()]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns), pa.array([sketches[i] for i in at], pa.binary())],
            ["key", "d", "h", "label", "sketch"],
        )


def _compared(compare: Compare, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links found in each block."""
    kind = pa.struct([("d", pa.int64()), ("h", pa.int64())])
    for _, held in _by_block(batches):
        ends = list(held)
        found = list(compare([r[2] for r in held.values()], [r[1] for r in held.values()], _classes(held)))
        sides = [[{"d": ends[p[k]][0], "h": ends[p[k]][1]} for p in found] for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(s, kind) for s in sides], ["a", "b"])


def _links(dealt: DataFrame, sketches: DataFrame, rows: DataFrame, screen: Screen, compare: Compare) -> DataFrame:
    """Links between the documents dealt (key, row, label) to one key."""
    same = lambda: (F.col("d") == F.col("_d")) & (F.col("h") == F.col("_h"))
    of = sketches.select(F.col("d").alias("_d"), F.col("h").alias("_h"), "sketch")
    flat = dealt.select("key", "row.d", "row.h", "label")
    known = flat.join(of, same()).select("key", "d", "h", "label", "sketch")
    known = known.repartition("key").sortWithinPartitions("key")
    likely = stored(
        known.mapInArrow(partial(_screened, screen), "key long, d long, h long, label long, sketch binary")
    )

    needed = likely.select("d", "h").distinct()
    passes = repeats.bloom(needed)(F.col("d"), F.col("h"))
    ends = needed.select(F.col("d").alias("_d"), F.col("h").alias("_h"))
    texts = rows.where(passes).join(ends, same(), "left_semi").groupBy("d", "h").agg(F.first("text").alias("text"))
    texts = texts.select(F.col("d").alias("_1"), F.col("h").alias("_2"), "text")
    whole = likely.join(texts, (F.col("d") == F.col("_1")) & (F.col("h") == F.col("_2")))
    whole = whole.select("key", "d", "h", "label", "sketch", "text").repartition("key").sortWithinPartitions("key")
    return whole.mapInArrow(partial(_compared, compare), _PAIR)


def _counted(rows: DataFrame, by: list[str]) -> DataFrame:
    """Number of blocks of each group."""
    need = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / SYMBOLS), F.lit(1))
    return rows.groupBy(*[F.col(c).alias(f"_{c}") for c in by]).agg(need.cast("int").alias("blocks"))


def _place(blocks: str = "blocks") -> Column:
    return F.pmod(F.xxhash64("row"), F.col(blocks)).cast("int")


def shared_buckets(members: DataFrame) -> DataFrame:
    """Members (bucket, row, size) of buckets with several rows, and the first row
    of each bucket as `star`."""
    stars = members.groupBy(F.col("bucket").alias("_b")).agg(F.min("row").alias("star"), F.count("*").alias("n"))
    return members.join(stars.where("n > 1"), F.col("bucket") == F.col("_b")).drop("_b", "n")


def often_shared(members: DataFrame, least: Column) -> DataFrame:
    """Members of the rows that have at least so many buckets with other rows."""
    shared = stored(shared_buckets(members))
    enough = shared.groupBy(F.col("row").alias("_row"), "size").agg(F.count("*").alias("_n"))
    enough = enough.where(F.col("_n") >= least)
    return shared.join(enough.select("_row"), F.col("row") == F.col("_row"), "left_semi").drop("star")


def classes(
    members: DataFrame,
    rows: DataFrame,
    sketches: DataFrame,
    screen: Screen,
    compare: Compare,
    ratio: float = 0.0,
    least: Column | None = None,
) -> DataFrame:
    """`node` and `root`, the least row of its class, for rows that aren't roots.

    `members` has bucket, row (d, h) and size (symbols); no row is twice in a
    bucket.  `rows` has d, h and text, `sketches` d, h and sketch (binary).  All
    pairs of rows that share a bucket are compared, but for those that are known
    to be in one class.  Rows whose sizes differ by more than `ratio` may be left
    out, and so may rows of a size that share fewer than `least` buckets.
    """
    if least is not None:
        # What shared with a row that is out may be out as well.
        members = often_shared(often_shared(members, least), least)
    shared = stored(shared_buckets(members))
    groups = stored(shared.groupBy("row", "size").agg(F.min("star").alias("group")))
    counted = stored(_counted(groups, ["group"]))
    in_group = groups.join(counted, F.col("group") == F.col("_group"))
    placed = in_group.select(F.xxhash64("group", _place()).alias("key"), "row", "group", "blocks", "size")
    firsts = counted.select(
        F.col("_group").alias("row"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at")
    )
    dealt = placed.where("row != group").select("key", "row").union(firsts.select(F.xxhash64("row", "at"), "row"))
    dealt = dealt.withColumn("label", F.xxhash64("row"))
    roots = components(_links(dealt, sketches, rows, screen, compare))

    named = shared.join(roots, F.col("row") == F.col("node"), "left").select(
        "bucket", "row", "size", F.coalesce("root", "row").alias("root")
    )
    several = named.groupBy(F.col("bucket").alias("_b")).agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    unsettled = stored(named.join(several.where("lo < hi"), F.col("bucket") == F.col("_b")).drop("_b", "lo", "hi"))
    if unsettled.isEmpty():
        return roots
    blocks = _reblocked(unsettled, in_group)
    pairs = _block_pairs(unsettled, blocks, ratio)
    both = pairs.select("key", F.explode(F.array_distinct(F.array("i", "j"))).alias("at"))
    dealt = both.join(blocks, F.col("at") == F.col("block")).select(
        "key", "row", F.xxhash64("root").alias("label")
    )
    more = _links(dealt, sketches, rows, screen, compare)
    joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(joined.union(more))


def _reblocked(unsettled: DataFrame, in_group: DataFrame) -> DataFrame:
    """Blocks of the rows that aren't settled: block, row, root, size, whole.

    Rows of a class larger than a block go to blocks of that class alone, which
    needn't be compared with each other; the others stay in their group's.
    `whole` marks groups that were one block, which was compared.
    """
    rows = unsettled.groupBy("row", "size", "root").agg(F.count("*").alias("_n")).drop("_n")
    of = in_group.select(F.col("row").alias("_row"), "group", (F.col("blocks") == 1).alias("whole"))
    rows = rows.join(of, F.col("row") == F.col("_row")).drop("_row")
    large = rows.groupBy(F.col("root").alias("_root")).agg(F.count("*").alias("_n")).where(F.col("_n") > BLOCK)
    rows = rows.join(large, F.col("root") == F.col("_root"), "left")
    apart = F.col("_root").isNotNull()
    rows = rows.select(
        "row", "size", "root", F.when(apart, F.col("root")).otherwise(F.col("group")).alias("group"),
        apart.alias("apart"), (~apart & F.col("whole")).alias("whole"),
    )
    rows = stored(rows)
    counted = _counted(rows, ["group", "apart"])
    same = (F.col("group") == F.col("_group")) & (F.col("apart") == F.col("_apart"))
    block = F.xxhash64("group", "apart", _place())
    return stored(rows.join(counted, same).select(block.alias("block"), "row", "root", "size", "whole"))


def _block_pairs(unsettled: DataFrame, blocks: DataFrame, ratio: float) -> DataFrame:
    """Blocks i <= j with rows of one bucket in different classes, each pair once."""
    of = blocks.select("block", F.col("row").alias("_row"), "whole")
    held = unsettled.join(of, F.col("row") == F.col("_row")).groupBy("bucket", "block").agg(
        F.min("root").alias("lo"),
        F.max("root").alias("hi"),
        F.min("size").alias("least"),
        F.max("size").alias("most"),
        F.min("whole").alias("whole"),
    )
    held = stored(held)
    one, two = held.alias("x"), held.alias("y")
    classes_differ = ~(
        (F.col("x.lo") == F.col("x.hi")) & (F.col("y.lo") == F.col("y.hi")) & (F.col("x.lo") == F.col("y.lo"))
    )
    fits = (F.col("x.most") >= F.col("y.least") * ratio) & (F.col("y.most") >= F.col("x.least") * ratio)
    new = (F.col("x.block") < F.col("y.block")) | ((F.col("x.block") == F.col("y.block")) & ~F.col("x.whole"))
    found = one.join(two, (F.col("x.bucket") == F.col("y.bucket")) & new & classes_differ & fits)
    found = found.select(F.col("x.block").alias("i"), F.col("y.block").alias("j")).distinct()
    return found.withColumn("key", F.xxhash64("i", "j"))
