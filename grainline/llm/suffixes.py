"""Removal of byte windows that occur earlier, by distributed prefix doubling.

Positions are ranked by the string that begins there, at growing lengths; a
position whose rank is unique is done.  The first ranks are names of the short
strings that stand for a stretch of positions; Spark sorts by them, and stretches
with unique ranks drop out.  What is left is shuffled by rank, and inside a shard
the ranks of pairs at doubled offsets are sorted and numbered again until they
are unique or reach the length of a window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grainline.llm import repeats
from grainline.llm.common import hex_sha256, starts_of, stored, texts_of

WINDOW = repeats.BYTES.window
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"

#: Segments whose positions are ranked at once; a shard's key is never split.
SEGMENTS = 4096


def reranked(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of pairs of ranks, and how many positions share each position's rank."""
    order = np.lexsort((right, left))
    new = np.ones(len(order), bool)
    new[1:] = (left[order][1:] != left[order][:-1]) | (right[order][1:] != right[order][:-1])
    number = np.cumsum(new) - 1
    rank = np.empty(len(order), np.int64)
    rank[order] = number
    return rank, np.bincount(number)[rank]


def doubled_ranks(data: np.ndarray, room: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of `wanted` whose window isn't unique, and the windows' ranks.

    `room` is the number of bytes from a position to the end of its segment.
    Ranks are of strings of doubled lengths; the last step overlaps.  A wanted
    position drops out once its rank is unique.
    """
    n = len(data)
    rank, size = data.astype(np.int64), 1
    while True:
        step = size if 2 * size <= WINDOW else WINDOW - size
        # Only positions that some wanted window is made of are ranked further.
        need = np.zeros(n + 1, np.int64)
        np.add.at(need, wanted, 1)
        np.add.at(need, np.minimum(wanted + WINDOW - size - step + 1, n), -1)
        at = np.flatnonzero((np.cumsum(need[:-1]) > 0) & (room >= size + step))
        named, shared = reranked(rank[at], rank[at + step])
        size += step
        rank = np.full(n, -1, np.int64)
        rank[at] = named
        count = np.zeros(n, np.int64)
        count[at] = shared
        wanted = wanted[count[wanted] > 1]
        if size == WINDOW or not len(wanted):
            return wanted, rank[wanted]


def repeated_windows(rows: list[tuple]) -> list[tuple]:
    """Spans of windows that occur earlier, of segments with whole keys.

    `rows`: key, d, h, first, count and body of each segment.
    """
    bodies = [x[5] for x in rows]
    lengths = np.array([len(x) for x in bodies], np.int64)
    starts = starts_of(lengths)
    owner = np.repeat(np.arange(len(rows)), lengths)
    at = np.arange(int(starts[-1]))
    room = starts[owner + 1] - at
    wanted, rank = doubled_ranks(np.frombuffer(b"".join(bodies), np.uint8), room, at[room >= WINDOW])
    seg = owner[wanted]
    d, h, first = (np.array([x[i] for x in rows], np.int64)[seg] for i in (1, 2, 3))
    place = first + wanted - starts[seg]
    order = np.lexsort((place, h, d, rank))
    head = np.ones(len(order), bool)
    head[1:] = rank[order][1:] != rank[order][:-1]
    # Equal rows have equal places; those are one place.
    least = order[np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    other = (d[order] != d[least]) | (h[order] != h[least]) | (place[order] != place[least])
    again = np.sort(wanted[order[other]])
    found = []
    for begin, n in repeats.stretches(again):
        # Segments lie next to each other, so a stretch may reach into the next.
        while n > 0:
            s = owner[begin]
            part = min(n, int(starts[s + 1]) - begin)
            found.append((rows[s][1], rows[s][2], rows[s][3] + begin - int(starts[s]), part))
            begin, n = begin + part, n - part
    return found


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in repeats.by_key(batches, SEGMENTS):
        found = repeated_windows(rows)
        if found:
            yield repeats.spans_batch(found)


def _cut(text: bytes):
    return lambda first, count: text[first : first + count + WINDOW - 1]


def repeated_spans(rows: DataFrame) -> DataFrame:
    """d, h, first and count of windows that also start earlier."""
    found = repeats.find_repeats(rows, repeats.byte_symbols, repeats.BYTES, inner=True)
    few, many = repeats.open_runs(found)
    parts = repeats.segments(rows, few, _cut).repartition("key").sortWithinPartitions("key")
    doubled = parts.mapInArrow(_shards, repeats.SPANS)
    windows = repeats.window_names(rows, many, _cut, repeats.byte_symbols, repeats.BYTES)
    looked_up = repeats.repeated_names(windows, inner=True)
    whole = found.where("not open").select("d", "h", "first", "count")
    return stored(whole.unionByName(doubled).unionByName(looked_up))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        offsets, (first, count) = repeats.lists_of(batch.column(2))
        out: list[tuple] = []
        for i, text in enumerate(texts_of(batch.column(1))):
            a, b = offsets[i], offsets[i + 1]
            gone = repeats.covered(first[a:b], count[a:b], WINDOW, len(text)) if b > a else None
            if gone is None:
                out.append((len(text), 0, 0, hex_sha256(text)))
                continue
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
            out.append((len(text), int(gone.sum()), spans, hex_sha256(kept)))
        columns = list(zip(*out, strict=True)) or [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(x, k) for x, k in zip(columns, kinds, strict=True))],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def _none() -> Column:
    return F.array().cast("array<struct<first:int,count:int>>")


def deduplicated(docs: DataFrame) -> DataFrame:
    """Bytes, removed bytes and spans, and a digest of the remaining bytes.

    A byte goes if a string of 100 bytes that also starts earlier covers it:
    earlier is in a document with a smaller doc_id, or before in the same one,
    judged on the texts as they are.  A null doc_id comes after all others; of
    rows with one doc_id and different texts, the one with the smaller hash of
    its text is earlier; rows that are wholly equal count as one text.  Null and
    empty texts have no bytes.  One row for each row of `docs`; further columns
    are not returned.
    """
    rows = repeats.rows_of(docs)
    some, rest = repeats.with_lists(rows, repeated_spans(rows))
    some = some.select("doc_id", "text", F.coalesce("listed", _none()).alias("listed"))
    rest = rest.select("doc_id", "text", _none().alias("listed"))
    return some.mapInArrow(_digest, SCHEMA).unionByName(rest.mapInArrow(_digest, SCHEMA))
