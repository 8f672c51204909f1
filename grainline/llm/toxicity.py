"""Toxicity: logistic regression over hashed word n-grams and skip-grams,
trained by FTRL-proximal.

Every coordinate has its own rate, and the L1 term leaves most weights at zero,
so the weights that are broadcast are few.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm.common import MIX, bound_batches, chunks, mixed, remainder, starts_of, texts_of

#: Labelled rows of each class that the classifier is fitted on, at most.
SAMPLE_PER_CLASS = 8192
BITS = 20
#: Rates, L1, L2 and epochs were chosen on a part of the rows to learn from, by
#: the share of toxic documents found in the rest of them.
ALPHA, BETA = 2.0, 1.0
L1, L2, EPOCHS = 20.0, 0.1, 10
#: A word also counts by its first bytes, as endings vary.
STEMS = (5, 6, 7, 8)
TOXIC_FROM = 0.7
FOLDS, HELD_OUT = 3, 1

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"

_PLAIN = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\"()[]{}", bytes(range(97, 123)) + b" " * 13
)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of consecutive texts and the text that each belongs to.

    Words, their stems, pairs of neighbours, and pairs with one word between;
    bucket 0 is left to the bias.
    """
    words = [t.translate(_PLAIN).split() for t in texts]
    starts = starts_of(np.array([len(w) for w in words], np.int64))
    n = int(starts[-1])
    h = np.fromiter((x for w in words for x in map(xxhash.xxh3_64_intdigest, w)), np.uint64, n)
    text = np.repeat(np.arange(len(texts)), np.diff(starts))
    found, owner = [h], [text]
    for size in STEMS:
        stems = (x[:size] for w in words for x in w)
        stem = np.fromiter(map(xxhash.xxh3_64_intdigest, stems), np.uint64, n)
        found.append(mixed(stem + np.uint64(16 * size)))
        owner.append(text)
    for gap in (1, 2):
        if n > gap:
            together = text[:-gap] == text[gap:]
            pair = mixed(h[:-gap] + np.uint64(gap)) * MIX + h[gap:]
            found.append(pair[together])
            owner.append(text[:-gap][together])
    bucket = mixed(np.concatenate(found)) >> np.uint64(64 - BITS)
    return np.maximum(bucket, 1).astype(np.int64), np.concatenate(owner)


def fit(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Weights after passing over the rows in order; a row holds its buckets.

    Both classes weigh the same, so a rare one isn't given up for the other.
    """
    toxic = labels.sum()
    heavier = (len(labels) - toxic) / toxic if 0 < toxic < len(labels) else 1.0
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _ in range(EPOCHS):
        for row, label in zip(rows, labels, strict=True):
            zi, ni = z[row], n[row]
            w = _weights(zi, ni)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            g *= heavier if label else 1.0
            rate = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[row] = zi + g - rate * w
            n[row] = ni + g * g
    return _weights(z, n)


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The proximal step: zero as long as the gradients sum up to less than L1."""
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, labels = [], []
    for batch in batches:
        for text, label in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
            rows.append(np.union1d([0], features([text])[0]).astype(np.int32))
            labels.append(label)
    w = fit(rows, np.array(labels, float))
    kept = np.flatnonzero(w)
    yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(w[kept])], ["bucket", "weight"])


def model(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> np.ndarray:
    """Weights by bucket, fitted on a sample of at most `per_class` labelled
    documents of each class, the first by a hash of doc_id.

    The sample's texts meet in one task, which their number bounds.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(remainder(F.col("doc_id"), FOLDS) != HELD_OUT)
        .groupBy(F.col("doc_id").cast("long").alias("_id"))
        .agg(F.max("toxic").cast("int").alias("_toxic"))
    )
    place = F.xxhash64("_id")
    one = lambda c: marked.where(F.col("_toxic") == c).orderBy(place, "_id").limit(per_class)
    sample = F.broadcast(one(1).union(one(0)))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    texts = texts.join(sample, F.col("doc_id") == F.col("_id")).dropDuplicates(["doc_id", "text"])
    ordered = texts.select("text", "_toxic", place.alias("_at"), "_id").repartition(1)
    ordered = ordered.sortWithinPartitions("_at", "_id", "text").select("text", "_toxic")
    got = ordered.mapInArrow(_fit, "bucket long, weight double").toPandas()
    weights = np.zeros(1 << BITS, np.float64)
    weights[got.bucket.to_numpy()] = got.weight.to_numpy()
    return weights


def scores_of(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    """Probabilities; a feature counts once in a text."""
    total = np.full(len(texts), weights[0])
    bucket, owner = features(texts)
    used = weights[bucket] != 0
    once = np.unique(owner[used] << BITS | bucket[used])
    np.add.at(total, once >> BITS, weights[once & ((1 << BITS) - 1)])
    return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept, values = shared.value
    weights = np.zeros(1 << BITS)
    weights[kept] = values
    for batch in batches:
        texts = texts_of(batch.column(2))
        done = [scores_of(texts[a:b], weights) for a, b in chunks(map(len, texts))]
        score = np.concatenate(done) if done else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(score), pa.array((score >= TOXIC_FROM).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )


def score(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """Toxicity score of every document; one row for each row of `docs`.

    A null or empty text has the score of the bias alone.  A document that any
    of its labels calls toxic counts as toxic in training; labels that are null
    or of unknown documents are left aside, and without labels every score is
    one half.  Repeated rows have equal scores; further columns are not
    returned.  Texts are read whole.
    """
    weights = model(docs, labels, per_class)
    kept = np.flatnonzero(weights)
    shared = docs.sparkSession.sparkContext.broadcast((kept, weights[kept]))
    return docs.select(
        F.col("doc_id").cast("long"),
        (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.col("text").cast("string"),
    ).mapInArrow(partial(_rows, shared), SCHEMA)
