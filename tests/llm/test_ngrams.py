"""n-gram links and block comparison against all pairs."""

import random

import numpy as np
import pytest
from brute import WORD

from grainline.llm import blocks, ngrams

DOCS = "doc_id long, text string"


def grams(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def plain(docs, least=85):
    sets = [(i, grams(t)) for i, t in docs]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x, (_, a) in enumerate(sets):
        for y, (_, b) in enumerate(sets[:x]):
            if a and b and 100 * len(a & b) >= least * len(a | b):
                up[root(x)] = root(y)
    members = {}
    for x in range(len(sets)):
        members.setdefault(root(x), []).append(sets[x][0])
    low = {r: min((d for d in ds if d is not None), default=None) for r, ds in members.items()}
    return sorted(((d, len(a), low[root(x)]) for x, (d, a) in enumerate(sets)), key=str)


def found(frame, **options):
    return sorted(map(tuple, ngrams.linked(frame, **options).collect()), key=str)


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


def corpus(seed, size=12, common=True):
    """Chains and groups of near copies around the threshold, with lines in common."""
    draw = random.Random(seed)
    line = [f"line{i}" for i in range(30)]
    docs = []
    for _ in range(size):
        base = [f"w{draw.randrange(3000)}" for _ in range(draw.randint(5, 220))]
        base = base + line if common and draw.random() < 0.4 else base
        for _ in range(draw.randint(1, 9)):
            docs.append(base)
            # Each copy departs from the one before, so that links form chains.
            base = edited(draw, base, draw.randint(0, 5))
    draw.shuffle(docs)
    return [(i * 3, " ".join(w)) for i, w in enumerate(docs)]


@pytest.mark.parametrize("seed, block, symbols", [(1, 256, 10**6), (2, 3, 10**6), (3, 256, 300)])
def test_components_equal_all_pairs(spark, monkeypatch, seed, block, symbols):
    monkeypatch.setattr(blocks, "BLOCK", block)
    monkeypatch.setattr(blocks, "SYMBOLS", symbols)
    docs = corpus(seed)
    expected = plain(docs)
    assert len({r[2] for r in expected}) < len(docs)
    assert found(spark.createDataFrame(docs, DOCS).repartition(4)) == expected


def test_a_group_near_the_threshold_equals_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 8)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    docs = [(i, " ".join(edited(draw, base, draw.randint(1, 5)))) for i in range(90)]
    docs += [(500 + i, " ".join(base[:120] + [f"x{i}y{j}" for j in range(draw.randint(5, 40))])) for i in range(30)]
    expected = plain(docs)
    assert 5 < len({r[2] for r in expected}) < 110
    assert found(spark.createDataFrame(docs, DOCS)) == expected


def test_odd_texts(spark):
    docs = [
        (None, "a b c d e"), (None, "a b c d e"), (None, "q"), (1, None), (2, ""), (3, " \n\t"), (4, "Q"), (5, "É b"),
        (6, "é b"), (7, "a\x0bB\x0cc\x1fd"), (8, "a b c\x1fd"), (9, "A b c D e"), (9, "A b c D e"), (9, "else"),
        (10, "z " * 200_000), (11, "z z z z"), (12, "z z z"), (13, "a b c d e"),
    ]
    assert found(spark.createDataFrame(docs, DOCS)) == plain(docs)
    assert found(spark.createDataFrame([], DOCS)) == []
    assert found(spark.createDataFrame([(1, None)], DOCS)) == [(1, 0, 1)]


def test_further_columns_are_not_used(spark):
    docs = corpus(7, size=4)
    names = ", d int, h int, bucket int, row int, size int, n int, `a.b c` int"
    frame = spark.createDataFrame([(*r, 1, 2, 3, 4, 5, 6, 7) for r in docs], DOCS + names)
    assert found(frame) == plain(docs)


def test_overlaps_equal_set_sizes(monkeypatch):
    monkeypatch.setattr(ngrams, "COLUMNS", 7)
    draw = random.Random(2)
    texts = [" ".join(draw.choices("abc", k=draw.randint(0, 40))) for _ in range(20)]
    found = ngrams.overlaps(ngrams.shingle_sets([t.encode() for t in texts]))
    sets = [grams(t) for t in texts]
    expected = np.array([[len(a & b) for b in sets] for a in sets])
    apart = ~np.eye(20, dtype=bool)
    assert (found[apart] == expected[apart]).all()


def test_spanning_links_join_what_is_linked():
    draw = np.random.default_rng(1)
    for _ in range(20):
        linked = draw.random((30, 30)) < 0.05
        linked |= linked.T
        classes = draw.integers(0, 25, 30)
        forest, whole = blocks.Forest(classes), blocks.Forest(classes)
        for i, j in blocks.spanning(linked, classes):
            assert linked[i, j] and forest.join(i, j)
        for i, j in zip(*np.nonzero(linked), strict=True):
            whole.join(int(i), int(j))
        assert [forest.root(i) for i in range(30)] == [whole.root(i) for i in range(30)]
