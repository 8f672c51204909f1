"""Window removal against plain versions."""

import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from grainline.llm import repeats, substring, suffixes


def planted(seed):
    """Copies, edited copies, periodic and empty texts, passages, null ids."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["é", "a"]
    base = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 300))) for _ in range(8)]
    docs = []
    for i in range(45):
        kind = draw.random()
        if kind < 0.3:
            text = draw.choice(base)
        elif kind < 0.6:
            words = draw.choice(base).split(" ")
            for _ in range(draw.randint(1, 4)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            text = " ".join(words)
        elif kind < 0.7:
            text = "a " * draw.randint(0, 200)
        elif kind < 0.8:
            text = " ".join(draw.choices(vocabulary[:3], k=draw.randint(40, 200)))
        elif kind < 0.9:
            text = draw.choice(base)[draw.randint(0, 200) :] + "\n" + draw.choice(base)[5:700]
        else:
            text = draw.choice([None, "", " \n"])
        docs.append((i * 3 - 20, text))
    docs.append((None, base[0]))
    draw.shuffle(docs)
    return docs


def table(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("group", [2048, 2])
def test_words_equal_a_plain_version(spark, rows, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    docs = planted(1)
    found = rows(substring.deduplicated(table(spark, docs)))
    assert sorted(found, key=str) == sorted(brute.substring(docs), key=str)
    assert sum(r[2] for r in found) > 1000


@pytest.mark.parametrize("group", [2048, 2])
def test_bytes_equal_a_plain_version(spark, rows, monkeypatch, group):
    monkeypatch.setattr(repeats, "GROUP", group)
    docs = planted(2)
    found = rows(suffixes.deduplicated(table(spark, docs)))
    assert sorted(found, key=str) == sorted(brute.suffixes(docs), key=str)
    assert sum(r[2] for r in found) > 1000


def test_a_whole_table_equals_a_plain_version(spark, folder, rows):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    plain = [(r[0], r[1]) for r in docs.collect()]
    assert rows(substring.deduplicated(docs)) == sorted(brute.substring(plain))
    assert rows(suffixes.deduplicated(docs)) == sorted(brute.suffixes(plain))


def test_rewritten_documents_have_the_kept_words(spark, rows):
    docs = planted(3)
    wide = table(spark, docs).selectExpr("doc_id", "'x' AS h", "text", "7 AS listed", "1L AS n_chars")
    out = substring.deduplicated_documents(wide)
    assert out.columns == wide.columns
    found = {r["doc_id"]: r for r in out.collect()}
    for doc_id, words, kept in brute.kept_words(docs):
        text = dict(docs)[doc_id]
        row = found[doc_id]
        assert brute.WORD.findall(row["text"] or "") == kept
        assert (row["h"], row["listed"]) == ("x", 7)
        if len(kept) == len(words):
            assert row["text"] == text
        assert row["n_chars"] == (1 if text is None else len(row["text"]))


@pytest.mark.parametrize("operator", [substring.deduplicated, suffixes.deduplicated])
def test_edges(spark, rows, operator):
    schema = "doc_id long, text string, d string, h string, listed int, key int"
    assert rows(operator(spark.createDataFrame([], schema))) == []
    text = " ".join(f"word{i}" for i in range(60))
    twice = [(1, text, "x", "y", 1, 2), (1, text, "x", "y", 1, 2), (2, None, None, None, None, None)]
    found = rows(operator(spark.createDataFrame(twice, schema)))
    assert [r[0] for r in found] == [1, 1, 2]
    assert [r[2] for r in found] == [0, 0, 0]
    later = spark.createDataFrame([*twice, (3, text, None, None, None, None)], schema)
    assert rows(operator(later))[-1][2] == (60 if operator is substring.deduplicated else len(text))


@pytest.mark.parametrize("operator", [substring.deduplicated, suffixes.deduplicated])
def test_texts_with_one_short_hash_and_no_id_are_two_rows(spark, rows, operator):
    passage = " ".join(f"word{i}" for i in range(60))
    long, short = f"{passage} x9556", "short y19362"
    docs = spark.createDataFrame([(1, passage), (None, long), (None, short)], "doc_id long, text string")
    assert docs.where("doc_id is null").select(F.hash("text")).distinct().count() == 1
    found = rows(operator(docs))
    whole = 61 if operator is substring.deduplicated else len(long)
    gone = 60 if operator is substring.deduplicated else len(passage)
    size = 2 if operator is substring.deduplicated else len(short)
    assert sorted(r[1:3] for r in found if r[0] is None) == sorted([(whole, gone), (size, 0)])


def test_rewriting_keeps_texts_with_one_short_hash_apart(spark, rows):
    passage = " ".join(f"word{i}" for i in range(60))
    docs = [(1, passage), (None, f"{passage} x9556"), (None, "short y19362")]
    kept = substring.deduplicated_documents(spark.createDataFrame(docs, "doc_id long, text string"))
    assert sorted(r[0].split() for r in rows(kept, "text")) == sorted([passage.split(), ["x9556"], ["short", "y19362"]])


@pytest.mark.parametrize("inner", [True, False])
def test_equal_rows_send_their_runs_once(spark, inner):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    base = draw.choices(words, k=300)
    other = " ".join(base[:140] + draw.choices(words, k=20) + base[160:])
    docs = [(1, " ".join(base))] + [(None, other)] * 60
    symbols, shape, cut = (
        (repeats.byte_symbols, repeats.BYTES, suffixes._cut) if inner else (repeats.word_symbols, repeats.WORDS, substring._cut)
    )
    table = repeats.rows_of(spark.createDataFrame(docs, "doc_id long, text string").repartition(6))
    found = repeats.find_repeats(table, symbols, shape, inner)
    runs = found.where("open").collect()
    assert len(runs) == len(set(runs)) > 0
    few, _ = repeats.open_runs(found)
    bodies = repeats.segments(table, few, cut).select("key", "d", "h", "first", "count").collect()
    assert len(bodies) == len(set(bodies)) == len(runs)
    some, _ = repeats.with_lists(table, found.select("d", "h", "first", "count"))
    lists = [r["listed"] for r in some.where("listed is not null and doc_id is null").collect()]
    assert len(lists) == 60
    assert all(len(x) == len(set(x)) for x in lists)


def test_a_very_long_text(spark, rows):
    long = " ".join(f"v{i % 1000}" for i in range(300_000))
    docs = spark.createDataFrame([(1, long), (2, long[:5000])], "doc_id long, text string")
    one, two = rows(substring.deduplicated(docs))
    assert one[1:3] == (300_000, 0) and two[2] == two[1]
    one, two = rows(suffixes.deduplicated(docs))
    assert one[2] == len(long) - 4890 and two[2] == 5000


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=40), min_size=1, max_size=5))
def test_automaton_matches_equal_plain_search(sequences):
    automaton = substring.Automaton()
    *known, query = sequences
    for s in known:
        automaton.add(s)
    texts = ["".join(s) for s in known]
    text = "".join(query)
    for end, size in enumerate(automaton.matches(query), 1):
        fits = [n for n in range(end + 1) if any(text[end - n : end] in t for t in texts)]
        assert size == max(fits, default=0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=400).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=4))
def test_doubled_ranks_equal_plain_search(parts):
    found = suffixes.repeated_windows([(0, i, 0, 0, 0, p) for i, p in enumerate(parts)])
    got = {(d, k) for d, _, first, n in found for k in range(first, first + n)}
    seen, expected = set(), set()
    for i, p in enumerate(parts):
        for k in range(len(p) - 99):
            window = p[k : k + 100]
            if window in seen:
                expected.add((i, k))
            seen.add(window)
    assert got == expected


def test_runs_cover_every_window_once():
    draw = random.Random(5)
    texts = [bytes(draw.choices(b"ab", k=draw.randint(0, 900))) for _ in range(20)]
    runs = repeats.find_runs(*repeats.byte_symbols(texts), repeats.BYTES)
    for i, text in enumerate(texts):
        mine = runs.text == i
        windows = np.concatenate([np.arange(a, a + n) for a, n in zip(runs.first[mine], runs.count[mine])] or [[]])
        assert sorted(windows) == list(range(max(0, len(text) - 99)))
