"""Removal of word windows that an earlier document has, by suffix automata.

Documents are sharded by content: the windows that could be equal meet in one
shard.  In a shard the passages of earlier documents make up a suffix automaton,
and later passages are streamed through it for matching statistics: wherever
the longest match reaches the length of a window, that window is known.  Runs
that are wholly equal to an earlier one are decided before that by 64-bit names,
and so are the windows of a key with too many different runs for a shard.  An
automaton goes to the tasks whose passages share a key with it, not to all, as
all automata together grow with the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from grainline.llm import repeats
from grainline.llm.common import hex_sha256, stored, texts_of

WINDOW = repeats.WORDS.window
SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class Automaton:
    """Suffix automaton of several sequences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, steps: dict) -> int:
        self.next.append(steps)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, symbol: object, target: int) -> int:
        """A copy of `target` for the shorter strings that reach it from `state`."""
        copy = self._state(self.length[state] + 1, self.link[target], self.next[target].copy())
        self.link[target] = copy
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def add(self, sequence: list) -> None:
        last = 0
        for symbol in sequence:
            target = self.next[last].get(symbol)
            if target is not None:
                if self.length[target] != self.length[last] + 1:
                    target = self._split(last, symbol, target)
                last = target
                continue
            new = self._state(self.length[last] + 1, 0, {})
            state = last
            while state >= 0 and symbol not in self.next[state]:
                self.next[state][symbol] = new
                state = self.link[state]
            if state >= 0:
                target = self.next[state][symbol]
                if self.length[target] != self.length[state] + 1:
                    target = self._split(state, symbol, target)
                self.link[new] = target
            last = new

    def matches(self, sequence: list) -> Iterator[int]:
        """For each position, the longest match that ends there."""
        state = size = 0
        steps, link, length = self.next, self.link, self.length
        for symbol in sequence:
            target = steps[state].get(symbol)
            while target is None and state:
                state = link[state]
                size = length[state]
                target = steps[state].get(symbol)
            if target is None:
                size = 0
            else:
                state, size = target, size + 1
            yield size


def known_windows(group: list[tuple]) -> list[tuple]:
    """Spans of windows of a shard's passages that earlier documents have.

    `group`: key, d, h, first, count and body of passages, sorted by d.
    """
    automaton, found, at = Automaton(), [], 0
    final = group[-1][1]
    while at < len(group):
        same = [x for x in group[at:] if x[1] == group[at][1]]
        split = [x[5].split(b" ") for x in same]
        if at:
            for (_, d, h, first, _, _), words in zip(same, split, strict=True):
                ends = np.fromiter(automaton.matches(words), np.int64, len(words))
                starts = np.flatnonzero(ends >= WINDOW) - WINDOW + 1
                found += [(d, h, first + a, n) for a, n in repeats.stretches(starts)]
        if group[at][1] != final:
            for words in split:
                automaton.add(words)
        at += len(same)
    return found


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in repeats.by_key(batches):
        found, at = [], 0
        while at < len(rows):
            end = at
            while end < len(rows) and rows[end][0] == rows[at][0]:
                end += 1
            found += known_windows(rows[at:end])
            at = end
        if found:
            yield repeats.spans_batch(found)


def _cut(text: bytes):
    words = text.split()
    return lambda first, count: b" ".join(words[first : first + count + WINDOW - 1])


def repeated_spans(rows: DataFrame) -> DataFrame:
    """d, h, first and count of windows that a row with a smaller `d` has."""
    found = repeats.find_repeats(rows, repeats.word_symbols, repeats.WORDS, inner=False)
    few, many = repeats.open_runs(found)
    passages = repeats.segments(rows, few, _cut).repartition("key").sortWithinPartitions("key", "d", "h", "first")
    matched = passages.mapInArrow(_shards, repeats.SPANS)
    windows = repeats.window_names(rows, many, _cut, repeats.word_symbols, repeats.WORDS)
    looked_up = repeats.repeated_names(windows, inner=False)
    whole = found.where("not open").select("d", "h", "first", "count")
    return stored(whole.unionByName(matched).unionByName(looked_up))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, removed, digests = [], [], []
        for text, gone in _with_gone(batch, 1):
            words = text.split()
            sizes.append(len(words))
            removed.append(0 if gone is None else int(gone.sum()))
            kept = words if gone is None else [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
            digests.append(hex_sha256(b" ".join(kept)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_sha256"],
        )


def _with_gone(batch: pa.RecordBatch, at: int) -> Iterator[tuple[bytes, np.ndarray | None]]:
    """Texts of column `at` with the words that go, by the spans after it."""
    offsets, (first, count) = repeats.lists_of(batch.column(at + 1))
    for i, text in enumerate(texts_of(batch.column(at))):
        a, b = offsets[i], offsets[i + 1]
        if a == b:
            yield text, None
        else:
            yield text, repeats.covered(first[a:b], count[a:b], WINDOW, len(text.split()))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in _with_gone(batch, 0):
            if gone is not None:
                out, at = [], 0
                for word, x in zip(_WORD.finditer(text), gone.tolist(), strict=True):
                    if x:
                        out.append(text[at : word.start()])
                        at = word.end()
                text = b"".join(out) + text[at:]
            texts.append(text.decode())
        yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), *batch.columns[2:]], ["text", *batch.schema.names[2:]])


def _none() -> Column:
    return F.array().cast("array<struct<first:int,count:int>>")


def _listed(rows: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    some, rest = repeats.with_lists(rows, repeated_spans(rows))
    listed = F.coalesce("listed", _none()).alias("listed")
    pick = lambda frame, third: frame.select(*(third if c == "listed" else c for c in columns))
    return pick(some, listed), pick(rest, _none().alias("listed"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """Counts of words and of removed words, and a digest of the kept words.

    A window of 50 words is removed if a document with a smaller doc_id has it,
    judged on the texts as they are.  A null doc_id comes after all others.
    Null and empty texts have no words.  Repeated rows share their doc_id, so
    neither removes from the other.  One row for each row of `docs`; further
    columns are not returned.
    """
    some, rest = _listed(repeats.rows_of(docs), "doc_id", "text", "listed")
    return some.mapInArrow(_digest, SCHEMA).unionByName(rest.mapInArrow(_digest, SCHEMA))


def deduplicated_documents(docs: DataFrame) -> DataFrame:
    """`docs` without the repeated windows' words; white space around them stays.

    Texts without such words stay as they are; `n_chars`, if there is one,
    follows the text.
    """
    rest_of = [c for c in docs.columns if c != "text"]
    rows = docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        repeats.id_or_last(F.col("doc_id")).alias("d"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("h"),
        F.col("text").isNull().alias("empty"),
        F.struct(*[F.col(f"`{c}`") for c in rest_of]).alias("others"),
    )
    some, rest = _listed(rows, "text", "listed", "empty", "others")
    # As a type, not as text: a column may have any name.
    schema = StructType([rows.schema[c] for c in ("text", "empty", "others")])
    done = some.mapInArrow(_rewrite, schema).unionByName(
        rest.select("text", "empty", "others")
    )
    text = F.when(~F.col("empty"), F.col("text"))

    def column(name: str):
        if name == "text":
            return text.alias(name)
        old = F.col(f"others.`{name}`")
        if name == "n_chars":
            return F.coalesce(F.length(text).cast(docs.schema[name].dataType), old).alias(name)
        return old.alias(name)

    return done.select(*[column(c) for c in docs.columns])
