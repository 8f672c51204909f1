"""Near-duplicate documents by ProbMinHash, banding and verification.

A document is a multiset of word shingles.  Every shingle sends arrivals of a
Poisson process whose rate is its weight; each arrival falls on a random
register, and a register keeps the shingle of its first arrival.  Two documents'
registers agree with the probability Jaccard similarity of their weights.
Arrivals are drawn only until no later one can come first anywhere.

Documents that agree in a band of registers share a bucket.  They are compared
exactly, in blocks; links verified that way make up classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm import blocks, repeats
from grainline.llm.blocks import row_of
from grainline.llm.common import MIX, bound_batches, chunks, mixed, starts_of, stored, texts_of

SHINGLE = 5
SIMILAR = 0.8
#: With 28 bands of 6 registers a pair of similarity 0.8 meets in a bucket with
#: probability 0.9998, one of 0.3 with 0.02.
BANDS, ROWS = 28, 6
REGISTERS = BANDS * ROWS
#: Pairs in a bucket are compared exactly from this share of equal registers on,
#: three standard deviations under 0.8.
ESTIMATE = 0.7

#: `c1`, `c2` name the sequence of words; `bands` and `marks` are null without words.
SIGNED = "d long, h long, c1 long, c2 long, size long, bands array<long>, marks binary"


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[bytes]]]:
    """Distinct shingles of consecutive texts, their weights and text numbers.

    A text with fewer words than a shingle has one shingle of all its words.
    """
    words = [t.split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    starts = starts_of(sizes)
    n = int(starts[-1])
    h = np.fromiter((x for w in words for x in map(xxhash.xxh3_64_intdigest, w)), np.uint64, n)
    text = np.repeat(np.arange(len(texts)), sizes)
    place = np.arange(n) - starts[text]
    width = np.minimum(sizes, SHINGLE)[text]
    begins = np.flatnonzero(place + width <= sizes[text])
    name = np.zeros(len(begins), np.uint64)
    for i in range(SHINGLE):
        more = i < width[begins]
        name[more] = mixed(name[more] * MIX + h[begins[more] + i])
    owner = text[begins]
    order = np.lexsort((name, owner))
    name, owner = name[order], owner[order]
    head = np.ones(len(name), bool)
    head[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(head)
    weight = np.diff(np.append(at, len(name)))
    return name[at], weight.astype(np.float64), owner[at], words


_STEP, _REGISTER = 0xA24BAED4963EE407, np.uint64(0x9FB21C651E98DF25)


def registers(name: np.ndarray, weight: np.ndarray, owner: np.ndarray, n_texts: int) -> np.ndarray:
    """Shingle with the first arrival at each register (texts by registers)."""
    times = np.full(n_texts * REGISTERS, np.inf)
    winner = np.zeros(n_texts * REGISTERS, np.uint64)
    clock = np.zeros(len(name))
    number = 0
    while len(name):
        number += 1
        seed = mixed(name + np.uint64(number * _STEP % 2**64))
        uniform = ((seed >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
        clock = clock - np.log(uniform) / weight
        slot = owner * REGISTERS + (mixed(seed ^ _REGISTER) % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(times, slot, clock)
        first = times[slot] == clock
        winner[slot[first]] = name[first]
        # A process whose clock is past all first arrivals of its text is over.
        texts, local = np.unique(owner, return_inverse=True)
        latest = times.reshape(n_texts, REGISTERS)[texts].max(axis=1)
        goes_on = clock < latest[local]
        name, weight, owner, clock = name[goes_on], weight[goes_on], owner[goes_on], clock[goes_on]
    return winner.reshape(n_texts, REGISTERS)


def similarity(one: bytes, two: bytes) -> float:
    """Probability Jaccard similarity of two texts' shingles."""
    name, weight, owner, _ = shingles([one, two])
    return _jaccard(*(x[owner == i] for i in (0, 1) for x in (name, weight)))


def _jaccard(name_a: np.ndarray, a: np.ndarray, name_b: np.ndarray, b: np.ndarray) -> float:
    """Probability Jaccard similarity of two weightings; names are sorted.

    It is the sum over common shingles i of 1 / sum_j max(a_j / a_i, b_j / b_i).
    """
    at = np.searchsorted(name_b, name_a)
    both = name_b[np.minimum(at, len(name_b) - 1)] == name_a
    if not both.any():
        return 0.0
    at = at[both]
    ratio = b[at] / a[both]
    order = np.argsort(ratio, kind="stable")
    ratio, a_both, b_both = ratio[order], a[both][order], b[at][order]
    # A shingle of one text alone has the ratio 0 or infinity.
    lower = np.cumsum(a_both) + (a.sum() - a_both.sum())
    upper = b.sum() - np.cumsum(b_both)
    last = np.searchsorted(ratio, ratio, side="right") - 1
    return float((a_both / (lower[last] + upper[last] / ratio)).sum())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column(0))
        ds, hs = batch.column(1), batch.column(2)
        for a, b in chunks(map(len, texts)):
            name, weight, owner, words = shingles(texts[a:b])
            won = registers(name, weight, owner, b - a)
            key = np.zeros((b - a, BANDS), np.uint64)
            for i in range(ROWS):
                key = mixed(key * MIX + won[:, i::ROWS])
            key = mixed(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            marks = mixed(won).astype(np.uint8)
            some = [bool(w) for w in words]
            joined = [b" ".join(w) for w in words]
            # Texts without words are nobody's copies.
            one = [xxhash.xxh3_64_intdigest(x) for x in joined]
            two = [xxhash.xxh64_intdigest(x) for x in joined]
            yield pa.RecordBatch.from_arrays(
                [
                    ds.slice(a, b - a),
                    hs.slice(a, b - a),
                    pa.array(np.array(one, np.uint64).view(np.int64)),
                    pa.array(np.array(two, np.uint64).view(np.int64)),
                    pa.array(np.bincount(owner, minlength=b - a)),
                    pa.array([list(k) if x else None for k, x in zip(key, some, strict=True)], pa.list_(pa.int64())),
                    pa.array([m.tobytes() if x else None for m, x in zip(marks, some, strict=True)], pa.binary()),
                ],
                ["d", "h", "c1", "c2", "size", "bands", "marks"],
            )


def _pairs(sketches: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of likely pairs of different classes and their share of equal registers."""
    marks = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, REGISTERS)
    share = np.array([(marks == own).mean(axis=1) for own in marks])
    i, j = np.nonzero(np.triu(share >= ESTIMATE, k=1) & (classes[:, None] != classes[None, :]))
    return i, j, share[i, j]


def _likely(sketches: list[bytes], classes: np.ndarray) -> np.ndarray:
    i, j, _ = _pairs(sketches, classes)
    out = np.zeros(len(sketches), bool)
    out[i] = out[j] = True
    return out


def _linked(texts: list[bytes], sketches: list[bytes], classes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Similar texts of different classes, likeliest ones first.

    What is joined already isn't compared again.
    """
    name, weight, owner, _ = shingles(texts)
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    sets = [(name[a:b], weight[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    i, j, share = _pairs(sketches, classes)
    forest = blocks.Forest(classes)
    for at in np.argsort(-share, kind="stable"):
        x, y = int(i[at]), int(j[at])
        if forest.root(x) != forest.root(y) and _jaccard(*sets[x], *sets[y]) >= SIMILAR - 1e-12:
            forest.join(x, y)
            yield x, y


def classes_of(docs: DataFrame) -> DataFrame:
    """`d`, `h` of every row of `docs` and its class' first row `root`."""
    bound_batches(docs.sparkSession)
    rows = repeats.rows_of(docs)
    signed = stored(rows.select("text", "d", "h").mapInArrow(_sign, SIGNED))
    # Equal sequences of words need no comparing; their first row stands for them.
    copies = signed.where("bands is not null").groupBy("c1", "c2")
    firsts = stored(
        copies.agg(
            F.min(row_of()).alias("row"),
            F.first("size").alias("size"),
            F.first("bands").alias("bands"),
            F.first("marks").alias("marks"),
        )
    )
    members = firsts.select(F.explode("bands").alias("bucket"), "row", "size")
    sketches = firsts.select("row.d", "row.h", F.col("marks").alias("sketch"))
    roots = blocks.classes(members, rows, sketches, _likely, _linked)
    first = F.coalesce("row", row_of())
    placed = signed.select("d", "h", "c1", "c2", F.col("bands").isNotNull().alias("some")).alias("s").join(
        firsts.select(F.col("c1").alias("_1"), F.col("c2").alias("_2"), "row"),
        (F.col("c1") == F.col("_1")) & (F.col("c2") == F.col("_2")) & F.col("some"),
        "left",
    )
    placed = placed.select("d", "h", first.alias("first"))
    return placed.join(roots, F.col("first") == F.col("node"), "left").select(
        "d", "h", F.coalesce("root", "first").alias("root")
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id and whether the row stays, one row for each row of `docs`.

    A class is a set of documents linked by similarities of 0.8 or more over
    five-word shingles, weighted by how often they occur; its id is its smallest
    doc_id, and that document stays.  Texts with equal words are copies.  A text
    of fewer than five words is one shingle; a text without words, null or
    empty, is a class of its own.  Null doc_ids come last and give a null class
    id if no other is in the class.  Rows that are wholly equal share a class
    and stay or go together.  Further columns are not returned.
    """
    last = F.lit(repeats.NO_ID)
    doc = lambda c: F.when(F.col(c) != last, F.col(c))
    return classes_of(docs).select(
        doc("d").alias("doc_id"), doc("root.d").alias("class_id"), (row_of() == F.col("root")).alias("kept")
    )


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """One row of each class of `docs`, the first, with all columns.

    Of rows that share doc_id and text, the one whose other columns come first,
    as JSON, stays.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    classes = stored(classes_of(docs))
    gone = classes.where(row_of() != F.col("root")).select("d", "h", F.lit(0).alias("go"))
    again = classes.groupBy("d", "h").count().where("count > 1").select("d", "h", F.lit(1).alias("go"))
    rows = docs.select(
        repeats.id_or_last(F.col("doc_id")).alias("d"),
        F.xxhash64(text).alias("h"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"),
    )
    some, rest = repeats.with_lists(rows, stored(gone.union(again)))
    some = some.where(F.coalesce(~F.exists("listed", lambda x: x.go == 0), F.lit(True)))
    once = some.groupBy("d", "h").agg(F.min_by("whole", F.to_json("whole")).alias("whole"))
    return rest.select("whole.*").union(once.select("whole.*"))
