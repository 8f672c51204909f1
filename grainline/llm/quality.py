"""Quality rules: base counts, and a likelihood ratio of trusted to raw text.

Two multinomials over hashed four-byte grams are counted, one over all
documents and one over the trusted ones.  A document's verdict is the mean
logarithm of their ratio over its grams, against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from grainline.llm import repeats
from grainline.llm.common import bound_batches, chunks, id_or_last, mixed, starts_of, stored, texts_of

BUCKETS = 1 << 16
GRAM = 4
WINDOW = 5
#: Ratios are kept as whole numbers, so that sums don't depend on their order.
UNIT = 1 << 20

#: A document is kept from this mean log ratio on.  Text as in the trusted
#: documents lies above zero; text of another make lies below -1.
THRESHOLD = -0.3

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long,"
    " n_repeat_words long, base_failed boolean, kept boolean, llr double"
)

_IN_WORD = np.ones(256, np.int64)
_IN_WORD[[9, 10, 11, 12, 13, 32]] = 0
_IN_WORD[0x80:0xC0] = 0  # bytes that go on with a character
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(b"#*$%&|<>")] = 1


def gram_buckets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of the gram at each byte, and whether it ends in its text."""
    n = len(data)
    gram = np.zeros(n, np.uint32)
    wide = data.astype(np.uint32)
    for i in range(GRAM):
        if n > i:
            gram[: n - i] |= wide[i:] << np.uint32(8 * i)
    inside = np.ones(n, bool)
    lengths = np.diff(starts)
    for i in range(GRAM - 1):
        ends = starts[1:][lengths > i] - 1 - i
        inside[ends] = False
    return ((gram * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), inside


def counts_of(texts: list[bytes], trusted: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Grams by bucket, of all texts and of the trusted ones."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    bucket, inside = gram_buckets(data, starts_of(lengths))
    chosen = np.repeat(np.array(trusted, bool), lengths)
    return (
        np.bincount(bucket[inside], minlength=BUCKETS),
        np.bincount(bucket[inside & chosen], minlength=BUCKETS),
    )


def ratios(raw: np.ndarray, trusted: np.ndarray) -> np.ndarray:
    """Log ratio of each bucket in units, with one gram added to every count."""
    if not trusted.sum():
        return np.zeros(BUCKETS, np.int64)
    of = lambda c: np.log((c + 1.0) / (c.sum() + BUCKETS))
    return np.rint((of(trusted) - of(raw)) * UNIT).astype(np.int64)


def repeated_words(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each text, the words in windows that occur twice or more in it."""
    n, texts = len(hashes), len(starts) - 1
    if n < WINDOW:
        return np.zeros(texts, np.int64)
    text = np.repeat(np.arange(texts), np.diff(starts))
    width = n - WINDOW + 1
    key = np.zeros(width, np.uint64)
    for i in range(WINDOW):
        key = mixed(key + hashes[i : i + width])
    inside = np.flatnonzero(text[:width] == text[WINDOW - 1 :])
    key = mixed(key[inside] ^ mixed(text[inside].astype(np.uint64)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n + 1, np.int64)
    at = inside[again]
    np.add.at(covered, at, 1)
    np.add.at(covered, at + WINDOW, -1)
    total = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    return total[starts[1:]] - total[starts[:-1]]


def measure(texts: list[bytes], ratio: np.ndarray) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, mean ratio."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = starts_of(np.array([len(t) for t in texts], np.int64))

    def per_text(values: np.ndarray) -> np.ndarray:
        total = starts_of(values)
        return total[starts[1:]] - total[starts[:-1]]

    words = [t.split() for t in texts]
    n_words = np.array([len(w) for w in words], np.int64)
    hashes = np.fromiter(
        (h for w in words for h in map(xxhash.xxh3_64_intdigest, w)), np.uint64, int(n_words.sum())
    )
    dup = []
    for t in texts:
        lines = [x for x in t.split(b"\n") if x and not x.isspace()]
        dup.append(len(lines) - len(set(lines)))
    bucket, inside = gram_buckets(data, starts)
    sums = per_text(np.where(inside, ratio[bucket], 0))
    mean = sums / (np.maximum(per_text(inside.astype(np.int64)), 1) * float(UNIT))
    return (
        n_words,
        per_text(_IN_WORD[data]),
        per_text(_SYMBOL[data]),
        np.array(dup, np.int64),
        repeated_words(hashes, starts_of(n_words)),
        mean,
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        texts, marks = texts_of(batch.column(0)), batch.column(1).to_pylist()
        for a, b in chunks(map(len, texts)):
            more, chosen = counts_of(texts[a:b], marks[a:b])
            raw += more
            trusted += chosen
    seen = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays(
        [pa.array(seen), pa.array(raw[seen]), pa.array(trusted[seen])], ["bucket", "raw", "trusted"]
    )


def _counts(marked: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Grams by bucket of rows (text, trusted), of all and of the trusted ones.

    A task sends at most a row for each bucket, and so does the result.
    """
    counted = (
        marked.mapInArrow(_count, "bucket long, raw long, trusted long")
        .groupBy("bucket")
        .agg(F.sum("raw").alias("raw"), F.sum("trusted").alias("trusted"))
        .toPandas()
    )
    raw, trusted = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    raw[counted.bucket.to_numpy()] = counted.raw.to_numpy()
    trusted[counted.bucket.to_numpy()] = counted.trusted.to_numpy()
    return raw, trusted


def model(docs: DataFrame, trusted_ids: DataFrame) -> np.ndarray:
    """Log ratios of trusted to all documents; `trusted_ids` holds doc_ids, each once.

    All trusted documents are counted, and their texts stay where they are: a
    filter of fixed size marks them, and a few others besides.  Those are found by
    their ids alone; only their texts are moved, and what they counted is taken off.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("d"), F.lit(0).alias("h"), F.col("text").cast("string").alias("text")
    )
    ids = stored(trusted_ids.select(F.col("doc_id").cast("long").alias("d"), F.lit(0).alias("h")))
    passes = F.col("d").isNotNull() & repeats.bloom(ids)(F.col("d"), F.col("h"))
    raw, trusted = _counts(rows.select("text", passes.alias("trusted")))
    wrong = stored(rows.select("d", "h").where(passes).join(ids.select("d"), "d", "left_anti").distinct())
    if not wrong.isEmpty():
        maybe = rows.where(F.col("d").isNotNull() & repeats.bloom(wrong)(F.col("d"), F.col("h")))
        moved = maybe.join(wrong.select("d"), "d", "left_semi")
        trusted -= _counts(moved.select("text", F.lit(True).alias("trusted")))[1]
    return ratios(raw, trusted)


def trusted_documents(labels: DataFrame) -> DataFrame:
    """doc_ids that all of their labels call good."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("_least"))
        .where("_least = 1")
        .select("doc_id")
    )


def _rows(shared, threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ratio = shared.value
    for batch in batches:
        texts, done = texts_of(batch.column(1)), []
        for a, b in chunks(map(len, texts)):
            done.append(measure(texts[a:b], ratio))
        if not done:
            continue
        n_words, chars, symbols, dup, repeat, mean = (np.concatenate(x) for x in zip(*done, strict=True))
        failed = (n_words < 10) | (100 * repeat > 20 * n_words)
        columns = [n_words, chars, symbols, dup, repeat, failed, ~failed & (mean >= threshold), mean]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *map(pa.array, columns), *batch.columns[2:]],
            ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            + ["base_failed", "kept", "llr"]
            + batch.schema.names[2:],
        )


def judge(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Base counts and verdict of every document, one row for each row of `docs`.

    A null or empty text has no words, fails the base rules and isn't kept.
    Without trusted documents every ratio is zero, and the base rules alone
    decide.  Repeated rows are counted and judged as often as they occur;
    further columns of `docs` are not returned.  Texts are read whole, a few MB
    at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model(docs, trusted_ids))
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return chosen.mapInArrow(partial(_rows, shared, threshold), SCHEMA)


def kept_documents(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` with a good verdict, with all their columns.

    The columns pass through the task that judges them, so none is joined back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model(docs, trusted_ids))
    wide = docs.select(
        id_or_last(F.col("doc_id")).alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    # As a type, not as text: a column may have any name.
    schema = StructType([*StructType.fromDDL(SCHEMA).fields, wide.schema["_row"]])
    return wide.mapInArrow(partial(_rows, shared, threshold), schema).where("kept").select("_row.*")
