"""Where texts repeat: windows of a fixed length, grouped into runs.

A window's key is the least hash among the short grams inside it.  The key
depends on the window's content alone, so equal windows have equal keys, and
neighbouring windows mostly share one: a run is a stretch of windows of one text
with one key.  Runs stand for the windows wherever those need not be told apart.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.llm.common import MIX, NO_ID, bound_batches, chunks, id_or_last, mixed, starts_of, stored, texts_of

#: Windows in a run, at most; a longer stretch makes several runs.
RUN = 64
_BASE = 0xD6E8FEB86659FD93
_BACK = pow(_BASE, -1, 2**64)


@dataclass(frozen=True)
class Shape:
    """Symbols in a window and in a gram."""

    window: int
    gram: int

    @property
    def grams(self) -> int:
        return self.window - self.gram + 1


WORDS = Shape(50, 8)
BYTES = Shape(100, 48)


def word_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of consecutive texts, and where each text starts."""
    words = [t.split() for t in texts]
    starts = starts_of(np.array([len(w) for w in words], np.int64))
    hashes = (h for w in words for h in map(xxhash.xxh3_64_intdigest, w))
    return np.fromiter(hashes, np.uint64, int(starts[-1])), starts


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * MIX)


def byte_symbols(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Scrambled bytes of consecutive texts, and where each text starts."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    return _BYTE[data], starts_of(np.array([len(t) for t in texts], np.int64))


def doubled(ranks: np.ndarray, offset: int) -> np.ndarray:
    """Names of pairs of ranks `offset` apart; equal pairs have equal names."""
    if len(ranks) <= offset:
        return ranks[:0]
    return mixed(ranks[:-offset] * MIX + ranks[offset:])


def gram_names(symbols: np.ndarray, length: int) -> np.ndarray:
    """Names of all stretches of `length` symbols."""
    names, size = symbols, 1
    while 2 * size <= length:
        names, size = doubled(names, size), 2 * size
    return doubled(names, length - size) if size < length else names


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every `width` neighbours."""
    least, size = values, 1
    while 2 * size <= width:
        least, size = np.minimum(least[:-size], least[size:]), 2 * size
    rest = width - size
    return np.minimum(least[:-rest], least[rest:]) if rest else least


@dataclass
class Runs:
    """Runs of consecutive texts: text number, first window, number of windows,
    key, name of the run's content, and whether its key's gram is in it twice.
    """

    text: np.ndarray
    first: np.ndarray
    count: np.ndarray
    key: np.ndarray
    name: np.ndarray
    twice: np.ndarray


def find_runs(symbols: np.ndarray, starts: np.ndarray, shape: Shape) -> Runs:
    """All runs of consecutive texts."""
    n, width = len(symbols), shape.window
    if n < width:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none, none.astype(bool))
    grams = gram_names(symbols, shape.gram)
    key = sliding_least(grams, shape.grams)
    text = np.searchsorted(starts, np.arange(len(key)), side="right") - 1
    inside = np.arange(len(key)) + width <= starts[text + 1]
    begins = np.ones(len(key), bool)
    begins[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
    begins &= inside
    at = np.flatnonzero(begins)
    if not len(at):
        return find_runs(symbols[:0], starts, shape)
    # A stretch ends where the next begins, or where windows leave the text.
    stop = np.minimum(np.append(at[1:], len(key)), starts[text[at] + 1] - width + 1)
    pieces = -(-(stop - at) // RUN)
    number = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = np.repeat(at, pieces) + RUN * number
    count = np.minimum(np.repeat(stop, pieces) - first, RUN)
    powers = np.full(n + 1, np.uint64(_BASE))
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(symbols * powers[:-1], out=total[1:])
    back = np.full(n + 1, np.uint64(_BACK))
    back[0] = 1
    np.multiply.accumulate(back, out=back)
    end = first + count + width - 1
    name = mixed((total[end] - total[first]) * back[first] + count.astype(np.uint64))
    here = key[first]
    windows = np.lib.stride_tricks.sliding_window_view(grams, shape.grams)
    left = np.empty(len(first), np.int64)
    right = np.empty(len(first), np.int64)
    for a in range(0, len(first), 65536):
        b = min(a + 65536, len(first))
        left[a:b] = first[a:b] + (windows[first[a:b]] == here[a:b, None]).argmax(axis=1)
        last = first[a:b] + count[a:b] - 1
        right[a:b] = last + shape.grams - 1 - (windows[last][:, ::-1] == here[a:b, None]).argmax(axis=1)
    owner = text[first]
    return Runs(
        owner,
        first - starts[owner],
        count,
        here.view(np.int64),
        name.view(np.int64),
        left != right,
    )


# --- the same over a table -------------------------------------------------

Symbols = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]

#: A run by row (`d`, `h`), first window and number of windows.  `later` marks
#: runs of which an equal one comes before in the same task.
RUN_SCHEMA = "key long, name long, d long, h long, first int, count int, twice boolean, later boolean"
#: Runs that occur again: `open` ones are the first of their content but share
#: their key with others, so some of their windows may repeat; all windows of
#: the rest occur earlier.
FOUND_SCHEMA = "key long, d long, h long, first int, count int, open boolean"

#: Runs with one key that are compared in one task, at most; beyond that each of
#: their windows is looked up on its own.
GROUP = 2048

BLOOM_BITS = 1 << 25


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, text, and `d`, `h`: doc_id (null last) and a 64-bit hash of the text.

    Rows that share `d` and `h` are taken to be equal.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text.alias("text"),
        id_or_last(F.col("doc_id")).alias("d"),
        F.xxhash64(text).alias("h"),
    )


def _find(symbols: Symbols, shape: Shape, inner: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(0))
        ds, hs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
        for a, b in chunks(map(len, texts)):
            got = find_runs(*symbols(texts[a:b]), shape)
            d, h = ds[a:b][got.text], hs[a:b][got.text]
            order = np.lexsort((got.first, h, d, got.name, got.key))
            key, name, d, h, first = got.key[order], got.name[order], d[order], h[order], got.first[order]
            # Rows that are wholly equal have equal runs, which count once.
            once = _heads(key, name, d, h, first)
            order, key, name, d, h, first = (x[once] for x in (order, key, name, d, h, first))
            head = _heads(key, name)
            at = np.maximum.accumulate(np.where(head, np.arange(len(head)), 0))
            later = _differs((d, h, first), at) if inner else d > d[at]
            columns = [key, name, d, h, first.astype(np.int32), got.count[order].astype(np.int32), got.twice[order], later]
            yield pa.RecordBatch.from_arrays(
                list(map(pa.array, columns)), ["key", "name", "d", "h", "first", "count", "twice", "later"]
            )


def _differs(place: tuple[np.ndarray, ...], at: np.ndarray) -> np.ndarray:
    """Which rows have another place than the row `at` has."""
    return np.logical_or.reduce([x != x[at] for x in place])


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before in any of the columns."""
    head = np.ones(len(columns[0]), bool)
    if len(head) > 1:
        head[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return head


class _Sorter:
    """Tells repeated runs apart in a stream sorted by key, name and place.

    Of the last key only as many rows are held as decide about the next.
    """

    def __init__(self, inner: bool):
        self.inner = inner
        self.held: list[np.ndarray] | None = None

    def take(self, columns: list[np.ndarray], last: bool) -> list[np.ndarray] | None:
        done = np.zeros(len(columns[0]), bool)
        rows = [*columns, done]
        if self.held is not None:
            rows = [np.concatenate(x) for x in zip(self.held, rows, strict=True)]
        key, name, d, h, first, count, twice, done = rows
        if not len(key):
            return None
        key_head, name_head = _heads(key), _heads(key, name)
        of_key, at = np.cumsum(key_head) - 1, np.flatnonzero(name_head)
        of_name = np.cumsum(name_head) - 1
        is_first = ~_differs((d, h, first), at[of_name]) if self.inner else d == d[at][of_name]
        several = (np.bincount(of_key[at]) > 1)[of_key]
        ending = np.ones(len(key), bool) if last else of_key < of_key[-1]
        is_open = is_first & (several | (ending & twice & self.inner)) & ~done
        again = ~is_first & ~done
        out = is_open | again
        result = [x[out] for x in (key, d, h, first, count)] + [is_open[out]]
        if not last:
            end = of_key == of_key[-1]
            if several[-1]:
                keep = np.zeros(len(key), bool)
                keep[[np.flatnonzero(end & name_head)[0], at[-1]]] = True
            else:
                keep = end & is_first
            self.held = [x[keep] for x in rows[:-1]] + [(done | is_open)[keep]]
        return result


def _sort_out(inner: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in FOUND_SCHEMA.split(", ")]
    sorter = _Sorter(inner)

    def out(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names)

    none = [np.zeros(0, x) for x in (np.int64, np.int64, np.int64, np.int64, np.int32, np.int32, bool)]
    ends: list[tuple | None] = [None, None]

    def once(columns: list[np.ndarray], stream: int) -> list[np.ndarray]:
        """Columns without runs that equal rows sent before; these are neighbours."""
        if not len(columns[0]):
            return columns
        place = columns[:5]
        new = _heads(*place)
        new[0] = ends[stream] != tuple(x[0] for x in place)
        ends[stream] = tuple(x[-1] for x in place)
        return [x[new] for x in columns]

    for batch in batches:
        *columns, later = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        key, _, d, h, first, count, _ = once([x[later] for x in columns], 0)
        if len(key):
            yield out([key, d, h, first, count, np.zeros(len(key), bool)])
        rows = once([x[~later] for x in columns], 1)
        if len(rows[0]):
            got = sorter.take(rows, last=False)
            if got is not None and len(got[0]):
                yield out(got)
    got = sorter.take(none, last=True)
    if got is not None:
        yield out(got)


def find_repeats(rows: DataFrame, symbols: Symbols, shape: Shape, inner: bool) -> DataFrame:
    """Runs that repeat or may do so in part, of rows as from `rows_of`.

    With `inner`, a place is earlier than another if it comes first by row and
    position; without, only if its row has a smaller `d`.  Runs are shuffled
    once by key.  Of runs with equal content a task sends on only the first;
    the others are known to repeat and go to any partition.  Rows that are
    wholly equal count as one; an open run is put out once.
    """
    bound_batches(rows.sparkSession)
    runs = rows.select("text", "d", "h").mapInArrow(partial(_find, symbols, shape, inner), RUN_SCHEMA)
    place = F.when(F.col("later"), F.xxhash64("d", "first")).otherwise(F.col("key"))
    placed = runs.withColumn("at", place).repartition("at").drop("at")
    placed = placed.sortWithinPartitions("key", "name", "d", "h", "first")
    return stored(placed.mapInArrow(partial(_sort_out, inner), FOUND_SCHEMA))


def bloom(rows: DataFrame) -> Callable[[Column, Column], Column]:
    """A filter that lets pass all rows with (d, h) in `rows`, and few others.

    It has a fixed size.  Over more rows than it is meant for it lets more
    others pass, which costs time and changes no result, as a join follows.
    """
    bit = lambda seed: F.pmod(F.xxhash64(F.lit(seed), "d", "h"), F.lit(BLOOM_BITS))
    bits = rows.select(F.explode(F.array(bit(1), bit(2))).alias("bit"))
    words = (
        bits.groupBy(F.expr("bit div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("set"))
        .toArrow()
    )
    table = np.zeros(BLOOM_BITS // 64, np.int64)
    table[words.column("word").to_numpy()] = words.column("set").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast(table)

    @F.pandas_udf("boolean")
    def passes(one: pd.Series, two: pd.Series) -> pd.Series:
        held = np.ones(len(one), bool)
        for x in (one.to_numpy(), two.to_numpy()):
            held &= (shared.value[x >> 6] >> (x & 63)) & 1 == 1
        return pd.Series(held)

    def check(d: Column, h: Column) -> Column:
        one, two = (F.pmod(F.xxhash64(F.lit(s), d, h), F.lit(BLOOM_BITS)) for s in (1, 2))
        return passes(one, two)

    return check


def with_lists(rows: DataFrame, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may have entries in `listed`, with those entries, and the rest.

    A list is null if there is no entry after all.  Its entries are distinct,
    however many equal rows sent them, so it is as long as its row's text at most.
    """
    passes = bloom(listed.select("d", "h").distinct())(F.col("d"), F.col("h"))
    return _listed(rows.where(passes), listed, "left"), rows.where(~passes)


def _listed(rows: DataFrame, listed: DataFrame, how: str) -> DataFrame:
    entries = [c for c in listed.columns if c not in ("d", "h")]
    lists = listed.groupBy(F.col("d").alias("_d"), F.col("h").alias("_h")).agg(
        F.collect_set(F.struct(*entries)).alias("listed")
    )
    return rows.join(lists, (F.col("d") == F.col("_d")) & (F.col("h") == F.col("_h")), how).drop("_d", "_h")


def segments(rows: DataFrame, runs: DataFrame, cut: Callable[[bytes], Callable[[int, int], bytes]]) -> DataFrame:
    """Content of `runs` (key, d, h, first, count): key, d, h, first, count, body.

    `cut` takes a text and returns what gives the symbols from first, for count.
    One row stands for all that are wholly equal; a task sends one of them.
    """
    wanted = runs.select("d", "h", "key", "first", "count")
    passes = bloom(wanted.select("d", "h").distinct())(F.col("d"), F.col("h"))
    texts = rows.where(passes).groupBy("d", "h").agg(F.first("text").alias("text"))
    some = _listed(texts, wanted, "inner")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ds, hs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2))
            offsets, (key, first, count) = lists_of(batch.column(3))
            sizes = np.diff(offsets)
            bodies = []
            for i, text in enumerate(texts_of(batch.column(0))):
                part = cut(text)
                bodies += [part(int(first[j]), int(count[j])) for j in range(offsets[i], offsets[i + 1])]
            columns = [key, np.repeat(ds, sizes), np.repeat(hs, sizes), first, count, bodies]
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(columns, _SEGMENT, strict=True)],
                ["key", "d", "h", "first", "count", "body"],
            )

    schema = "key long, d long, h long, first int, count int, body binary"
    return some.select("text", "d", "h", "listed").mapInArrow(run, schema)


_SEGMENT = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())


def by_key(batches: Iterator[pa.RecordBatch], least: int = 1) -> Iterator[list[tuple]]:
    """Rows of a stream sorted by key: whole groups, `least` rows or more at once."""
    held: list[tuple] = []
    for batch in batches:
        held += zip(*(c.to_pylist() for c in batch.columns), strict=True)
        end = len(held)
        if end < least:
            continue
        while end and held[end - 1][0] == held[-1][0]:
            end -= 1
        if end:
            yield held[:end]
            held = held[end:]
    if held:
        yield held


SPANS = "d long, h long, first int, count int"


def spans_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(x, k) for x, k in zip(columns, _SEGMENT[1:5], strict=True)], ["d", "h", "first", "count"]
    )


def stretches(at: np.ndarray) -> list[tuple[int, int]]:
    """Start and length of the stretches of neighbours in sorted numbers."""
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) != 1) + 1
    return [(int(x[0]), len(x)) for x in np.split(at, cut)]


def window_names(
    rows: DataFrame, runs: DataFrame, cut: Callable[[bytes], Callable[[int, int], bytes]], symbols: Symbols, shape: Shape
) -> DataFrame:
    """Each window of `runs` by two independent names: w1, w2, d, h, first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h, first = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            values, starts = symbols([x.as_py() for x in batch.column(5)])
            if len(values) < shape.window:
                continue
            w1 = gram_names(values, shape.window)
            w2 = gram_names(mixed(values ^ MIX), shape.window)
            at = np.arange(len(w1))
            owner = np.searchsorted(starts, at, side="right") - 1
            inside = at + shape.window <= starts[owner + 1]
            at, owner = at[inside], owner[inside]
            columns = [
                w1[at].view(np.int64),
                w2[at].view(np.int64),
                d[owner],
                h[owner],
                (first[owner] + at - starts[owner]).astype(np.int32),
            ]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["w1", "w2", "d", "h", "first"])

    schema = "w1 long, w2 long, d long, h long, first int"
    return segments(rows, runs, cut).mapInArrow(run, schema)


def open_runs(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Open runs by the number that share their key: few, and too many to compare
    in one task.
    """
    runs = found.where("open")
    many = runs.groupBy(F.col("key").alias("_key")).count().where(F.col("count") > GROUP).select("_key")
    few = runs.join(many, F.col("key") == F.col("_key"), "left_anti")
    return few, runs.join(many, F.col("key") == F.col("_key"), "left_semi")


def lists_of(column: pa.Array) -> tuple[list[list], list[np.ndarray]]:
    """Row boundaries and flat fields of a column of lists of structs."""
    offsets = column.offsets.to_numpy()
    flat = column.flatten()
    return offsets, [flat.field(i).to_numpy(zero_copy_only=False) for i in range(flat.type.num_fields)]


def repeated_names(windows: DataFrame, inner: bool) -> DataFrame:
    """Windows (w1, w2, d, h, first) that occur earlier, as spans of one window.

    Every class of equal windows is named by its first place, from partial
    aggregates; a class with one member has no more to do.
    """
    place = F.struct("d", "h", "first") if inner else F.struct("d")
    classes = (
        windows.groupBy(F.col("w1").alias("_1"), F.col("w2").alias("_2"))
        .agg(F.min(place).alias("least"), F.max(place).alias("most"))
        .where("least < most")
    )
    joined = windows.join(classes, (F.col("w1") == F.col("_1")) & (F.col("w2") == F.col("_2")))
    return joined.where(place > F.col("least")).select("d", "h", "first", F.lit(1).alias("count"))


def covered(first: np.ndarray, count: np.ndarray, window: int, length: int) -> np.ndarray:
    """Which of `length` symbols lie in any of the given windows."""
    change = np.zeros(length + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + count + window - 1, -1)
    return np.cumsum(change[:-1]) > 0
