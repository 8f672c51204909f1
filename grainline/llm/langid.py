"""Language identification by mixture inference.

A language's model is a multinomial over hashed four-byte grams.  A document is
a mixture: runs of a few words come from one language each, with proportions
that expectation-maximisation estimates.  Of nested sets of languages the one
with the best penalised likelihood counts, and its largest share is the answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grainline.llm.common import bound_batches, chunks, remainder, starts_of, texts_of

BUCKETS = 1 << 16
GRAM = 4
UNIT_WORDS = 4
STEPS = 8
#: Likelihood that a further language has to gain, per log of the units.
PENALTY = 2.0
#: Languages under this share after the first round are dropped together.
LEAST_SHARE = 0.02
FOLDS, HELD_OUT = 4, 2
#: Log likelihoods are kept as whole numbers, so that sums don't depend on order.
SCALE = 1 << 12
UNKNOWN = "und"

SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"

_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_LETTER = regex.compile(r"\p{L}")


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket of the gram at each byte that isn't a space, its position in the
    texts (each followed by spaces), and where those texts start.
    """
    plain = [t.translate(_PLAIN) + b" " * GRAM for t in texts]
    starts = starts_of(np.array([len(t) for t in plain], np.int64))
    data = np.frombuffer(b"".join(plain), np.uint8)
    at = np.flatnonzero(data != 32)
    gram = np.zeros(len(at), np.uint32)
    for i in range(GRAM):
        gram |= data[at + i].astype(np.uint32) << np.uint32(8 * i)
    return ((gram * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64), at, starts


def units(data_at: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First gram of each unit of a few words, and the text of each unit."""
    text = np.searchsorted(starts, data_at, side="right") - 1
    first_of_word = np.ones(len(data_at), bool)
    first_of_word[1:] = np.diff(data_at) > 1
    words = np.flatnonzero(first_of_word)
    owner = text[words]
    place = np.arange(len(words)) - np.searchsorted(owner, owner)
    chosen = place % UNIT_WORDS == 0
    return words[chosen], owner[chosen]


def mixture(likely: np.ndarray, owner: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (texts by languages) of the best set, and whether a text has units.

    `likely` holds the log likelihood of each unit under each language; units
    come in the order of their texts.
    """
    n_langs = likely.shape[1]
    best_share = np.zeros((n_texts, n_langs))
    present, first, count = np.unique(owner, return_index=True, return_counts=True)
    has = np.zeros(n_texts, bool)
    has[present] = True
    if not len(present) or not n_langs:
        return best_share, has
    top = likely.max(axis=1)
    p = np.exp(likely - top[:, None])
    tops = np.add.reduceat(top, first)
    row = np.repeat(np.arange(len(present)), count)
    active = np.ones((len(present), n_langs), bool)
    best = np.full(len(present), -np.inf)
    chosen = np.zeros((len(present), n_langs))
    todo = np.arange(len(present))
    for stage in range(n_langs + 1):
        live = np.isin(row, todo) if len(todo) < len(present) else np.ones(len(row), bool)
        pl, lengths = p[live], count[todo]
        local = np.repeat(np.arange(len(todo)), lengths)
        begin = np.cumsum(lengths) - lengths
        share = active[todo] / active[todo].sum(axis=1, keepdims=True)
        for _ in range(STEPS):
            part = pl * share[local]
            part /= np.maximum(part.sum(axis=1, keepdims=True), 1e-300)
            share = np.add.reduceat(part, begin, axis=0) / lengths[:, None]
        fit = np.log(np.maximum((pl * share[local]).sum(axis=1), 1e-300))
        value = np.add.reduceat(fit, begin) + tops[todo]
        value = value - PENALTY * active[todo].sum(axis=1) * np.log(lengths + 1.0)
        better = value > best[todo]
        best[todo[better]] = value[better]
        chosen[todo[better]] = share[better]
        ranked = np.where(active[todo], share, np.inf)
        if stage == 0:
            drop = (share < LEAST_SHARE) & (share < share.max(axis=1, keepdims=True))
        else:
            drop = np.zeros_like(active[todo])
        none = ~drop.any(axis=1)
        drop[np.flatnonzero(none), ranked[none].argmin(axis=1)] = True
        more = active[todo].sum(axis=1) > 1
        active[todo[more]] &= ~drop[more]
        todo = todo[more]
        if not len(todo):
            break
    best_share[present] = chosen
    return best_share, has


def predict(texts: list[bytes], langs: list[str], table: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and share of each text."""
    bucket, at, starts = grams(texts)
    first, owner = units(at, starts)
    likely = np.zeros((len(first), len(langs)))
    for i in range(len(langs)):
        total = starts_of(table[i][bucket])
        ends = np.append(first[1:], len(bucket)) if len(first) else first
        likely[:, i] = (total[ends] - total[first]) / float(SCALE)
    share, has = mixture(likely, owner, len(texts))
    best = share.argmax(axis=1) if langs else np.zeros(len(texts), int)
    named, score = [], np.zeros(len(texts))
    for i, text in enumerate(texts):
        if not langs or not has[i] or not _LETTER.search(text.decode()):
            named.append(UNKNOWN)
        else:
            named.append(langs[best[i]])
            score[i] = min(1.0, share[i, best[i]])
    return named, score


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), texts_of(batch.column(1))
        for lang in set(langs):
            own = [t for t, x in zip(texts, langs, strict=True) if x == lang]
            total = seen.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for a, b in chunks(map(len, own)):
                total += np.bincount(grams(own[a:b])[0], minlength=BUCKETS)
    for lang, total in seen.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])],
            ["lang", "bucket", "n"],
        )


def model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and their log probabilities, from all documents to learn from.

    A task and the result have at most one row for each language and bucket.
    """
    bound_batches(docs.sparkSession)
    learned = docs.where(
        (remainder(F.col("doc_id"), FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    ).select(F.col("lang").cast("string"), F.col("text").cast("string"))
    got = (
        learned.mapInArrow(_count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    langs = sorted(set(got.lang))
    counts = np.zeros((len(langs), BUCKETS))
    place = {x: i for i, x in enumerate(langs)}
    counts[got.lang.map(place).to_numpy(int), got.bucket.to_numpy(int)] = got.n.to_numpy(float)
    total = counts.sum(axis=1, keepdims=True) + 0.5 * BUCKETS
    return langs, np.rint(np.log((counts + 0.5) / total) * SCALE).astype(np.int64)


def _rows(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    langs, table = shared.value
    for batch in batches:
        texts, named, scores = texts_of(batch.column(2)), [], [np.zeros(0)]
        for a, b in chunks(map(len, texts)):
            names, score = predict(texts[a:b], langs, table)
            named += names
            scores.append(score)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:2], pa.array(named, pa.string()), pa.array(np.concatenate(scores))],
            ["doc_id", "held_out", "lang_pred", "score"],
        )


def identify(docs: DataFrame) -> DataFrame:
    """Language of every document; one row for each row of `docs`.

    The answer is `und` with score 0 if the text is null or has no letter, or if
    no language was learned.  Shares tie towards the language first by name.
    Repeated rows have equal answers; further columns are not returned.  Texts
    are read whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model(docs))
    return docs.select(
        F.col("doc_id").cast("long"),
        (remainder(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        F.col("text").cast("string"),
    ).mapInArrow(partial(_rows, shared), SCHEMA)
