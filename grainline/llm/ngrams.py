"""Documents linked by the Jaccard similarity of their word n-grams.

The incidence of documents and n-grams is a sparse matrix, and its product with
its own transpose counts the n-grams that two documents share.  The product is
taken in blocks of documents.  A set of n n-grams links only with sets that share
at least 85 % of them, so of the first n - ceil(0.85 n) + k of both, in any order
that holds for all, k are common; blocks are multiplied only where that may be so.
The order puts rare n-grams first.  Within a block, counts are
accumulated over ranges of n-grams, and pairs under the bound that follows from
the two sizes are dropped: first with the counts among the first n-grams alone and
all others taken as common, then with those of whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.llm import blocks, repeats
from grainline.llm.blocks import row_of
from grainline.llm.common import MIX, bound_batches, chunks, mixed, starts_of, stored, texts_of

WIDTH = 4
#: Shared n-grams of linked documents in hundredths of all they have.
LEAST = 85
#: Linked sets have more than this share (in hundredths) of their n-grams in common
#: among the first ones of both, 85 % of it for the larger set.
FIRST = 5
#: Counters of n-grams by hash; they order n-grams and decide nothing else.
COUNTERS = 1 << 18
#: n-grams whose incidence is held at once, times documents of a block.
COLUMNS = 8192

SIGNED = "d long, h long, n long, c1 long, c2 long, prefix array<long>"


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of consecutive texts, with repeats, and where each text's start.

    A-Z count as a-z.  A text with fewer words than an n-gram has one of all its words.
    """
    words = [t.lower().split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = starts_of(sizes)
    n = int(starts[-1])
    h = np.fromiter((x for w in words for x in map(xxhash.xxh3_64_intdigest, w)), np.uint64, n)
    text = np.repeat(np.arange(len(texts)), sizes)
    width = np.minimum(sizes, WIDTH)[text]
    begins = np.flatnonzero(np.arange(n) - starts[text] + width <= sizes[text])
    name = np.zeros(len(begins), np.uint64)
    for i in range(WIDTH):
        more = i < width[begins]
        name[more] = mixed(name[more] * MIX + h[begins[more] + i])
    return name, np.searchsorted(text[begins], np.arange(len(texts) + 1))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct n-grams of each text, sorted."""
    name, ends = shingles(texts)
    return [np.unique(name[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _counter(name: np.ndarray) -> np.ndarray:
    return (name >> np.uint64(17)) % np.uint64(COUNTERS)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        texts = texts_of(batch.column(0))
        for a, b in chunks(map(len, texts)):
            name, _ = shingles(texts[a:b])
            total += np.bincount(_counter(name).astype(np.int64), minlength=COUNTERS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["counter", "n"])


def frequencies(rows: DataFrame) -> np.ndarray:
    """How many n-grams fall on each of the fixed number of counters."""
    counted = rows.select("text").mapInArrow(_count, "counter long, n long").groupBy("counter").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    out = np.zeros(COUNTERS, np.int64)
    out[table.column("counter").to_numpy()] = table.column("n").to_numpy()
    return out


def prefix_length(n: int, least: int) -> int:
    """How many n-grams of a set of n come first.

    Of two linked sets the smaller one has m n-grams, and the first k = FIRST * m
    // 100 + 1 common ones are among the first n - ceil(0.85 n) + k of either,
    whose length this is or exceeds.
    """
    return min(n, n - -(-n * least // 100) + n * FIRST // 100 + 1)


def common_first(least: int) -> Column:
    """How many of its first n-grams a set of `size` shares if it links at all."""
    return F.expr(f"size * {least * FIRST} div 10000") + 1


def _sign(shared, least: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(0))
        for a, b in chunks(map(len, texts)):
            sets = shingle_sets(texts[a:b])
            first = []
            for s in sets:
                order = np.lexsort((s, shared.value[_counter(s)]))
                first.append(s[order[: prefix_length(len(s), least)]] if len(s) else s)
            whole = [s.tobytes() for s in sets]
            names = (
                np.array([f(s) for s in whole], np.uint64).view(np.int64)
                for f in (xxhash.xxh3_64_intdigest, xxhash.xxh64_intdigest)
            )
            prefix = pa.ListArray.from_arrays(
                pa.array(starts_of(np.array([len(x) for x in first])).astype(np.int32)),
                pa.array(np.concatenate(first).view(np.int64)),
            )
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).slice(a, b - a), batch.column(2).slice(a, b - a), sizes, *map(pa.array, names), prefix],
                ["d", "h", "n", "c1", "c2", "prefix"],
            )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common n-grams of each two different sets: incidence times its
    transpose."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # An n-gram of one document is common to no two.
    several = count > 1
    columns = int(several.sum())
    column = (np.cumsum(several) - 1)[at]
    held = several[at]
    order = np.argsort(column[held], kind="stable")
    column, owner = column[held][order], owner[held][order]
    out = np.zeros((n, n), np.int64)
    for start in range(0, columns, COLUMNS):
        a, b = np.searchsorted(column, (start, start + COLUMNS))
        part = np.zeros((n, min(COLUMNS, columns - start)), np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def _bounded(both: np.ndarray, size: np.ndarray, least: int) -> np.ndarray:
    """Whether so many common n-grams are enough for sets of these sizes."""
    return both * (100 + least) >= (size[:, None] + size[None, :]) * least


def _likely(shared, least: int, sketches: list[bytes], classes: np.ndarray) -> np.ndarray:
    """Documents that may link with one of another class, by their first n-grams.

    Of two sets, all common n-grams up to the end of the shorter prefix are
    counted; those after it could at most all be common.
    """
    flat = [np.frombuffer(s, np.uint64) for s in sketches]
    size = np.array([int(f[0]) for f in flat], np.int64)
    prefix = [f[1:] for f in flat]
    names = np.unique(np.concatenate(prefix))
    rank = np.empty(len(names), np.int64)
    rank[np.lexsort((names, shared.value[_counter(names)]))] = np.arange(len(names))
    places = [np.sort(rank[np.searchsorted(names, p)]) for p in prefix]
    last = np.array([p[-1] for p in places])
    # How many of a set's n-grams come up to the end of another's prefix.
    upto = np.array([np.searchsorted(p, last, side="right") for p in places])
    rest = size[:, None] - upto
    may = _bounded(overlaps(prefix) + np.minimum(rest, rest.T), size, least)
    return (may & (classes[:, None] != classes[None, :])).any(axis=1)


def _linked(least: int, texts: list[bytes], sketches: list[bytes], classes: np.ndarray) -> Iterator[tuple[int, int]]:
    sets = shingle_sets(texts)
    size = np.array([len(s) for s in sets], np.int64)
    return blocks.spanning(_bounded(overlaps(sets), size, least), classes)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and first n-grams as one piece of data."""
    for batch in batches:
        size = batch.column(2).to_numpy().astype(np.uint64)
        prefix = batch.column(3)
        ends, flat = prefix.offsets.to_numpy(), prefix.values.to_numpy().view(np.uint64)
        data = [n.tobytes() + flat[a:b].tobytes() for n, a, b in zip(size, ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(data, pa.binary())], ["d", "h", "sketch"]
        )


def linked(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_shingles and component_id, one row for each row of `docs`.

    Two documents link when their sets of four-word n-grams share at least
    `least` hundredths of their union; a component is what links reach, and its
    id the smallest doc_id in it.  A text with one to three words is one n-gram;
    one without words, null or empty, links with nothing and is its own
    component.  Null doc_ids come last and give a null component id if no other
    is in the component.  Rows that are wholly equal share a component.  n-grams
    are told apart by 64-bit hashes.  Further columns are not used.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    rows = repeats.rows_of(docs)
    order = spark.sparkContext.broadcast(frequencies(rows))
    signed = stored(rows.select("text", "d", "h").mapInArrow(partial(_sign, order, least), SIGNED))
    # Equal sets are linked; the first document stands for the others.
    firsts = stored(
        signed.where("n > 0")
        .groupBy("c1", "c2")
        .agg(F.min(row_of()).alias("row"), F.first("n").alias("size"), F.first("prefix").alias("prefix"))
    )
    members = firsts.select(F.explode("prefix").alias("bucket"), "row", "size")
    sketches = firsts.select("row.d", "row.h", "size", "prefix").mapInArrow(_sketches, "d long, h long, sketch binary")
    screen, compare = partial(_likely, order, least), partial(_linked, least)
    roots = blocks.classes(members, rows, sketches, screen, compare, least / 100, common_first(least))
    named = signed.select("d", "h", "n", "c1", "c2").join(
        firsts.select(F.col("c1").alias("_1"), F.col("c2").alias("_2"), "row"),
        (F.col("c1") == F.col("_1")) & (F.col("c2") == F.col("_2")) & (F.col("n") > 0),
        "left",
    )
    named = named.select("d", "n", F.coalesce("row", row_of()).alias("first"))
    found = named.join(roots, F.col("first") == F.col("node"), "left")
    doc = lambda c: F.when(c != repeats.NO_ID, c)
    return found.select(
        doc(F.col("d")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        doc(F.coalesce("root.d", "first.d")).alias("component_id"),
    )
