"""Near-duplicate classes and components against plain versions."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from grainline.llm import blocks
from grainline.llm import components as graph
from grainline.llm import probminhash as near
from grainline.llm.components import components


def edited(draw, words, n):
    words = list(words)
    for _ in range(n):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


def corpus(seed=1):
    draw = random.Random(seed)
    docs = []
    for _ in range(12):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.randint(30, 200))]
        docs.append(base)
        for _ in range(draw.randint(0, 5)):
            docs.append(edited(draw, base, draw.randint(0, 4)))
        docs.append(base[: len(base) // 2] * 2)
    docs += [["a"], ["a"], ["a", "b"], [], []]
    draw.shuffle(docs)
    return [(i * 2, " ".join(w)) for i, w in enumerate(docs)]


def test_classes_equal_all_pairs(spark, rows):
    docs = corpus()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    found = rows(near.near_duplicates(frame), "doc_id", "class_id")
    assert found == sorted(brute.classes(docs))
    assert len({c for _, c in found}) < len(found)


def test_a_whole_table_equals_all_pairs(spark, folder, rows):
    frame = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    docs = [(r[0], r[1]) for r in frame.collect()]
    found = near.near_duplicates(frame)
    assert rows(found, "doc_id", "class_id") == sorted(brute.classes(docs))
    kept = near.deduplicated_documents(frame)
    assert rows(kept, "doc_id") == rows(found.filter("kept"), "doc_id")


def test_a_large_group_of_near_copies_is_one_class(spark, rows, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 16)
    draw = random.Random(3)
    base = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join(base if i == 0 else edited(draw, base, 4))) for i in range(150)]
    docs += [(1000 + i, " ".join(f"x{i}y{j}" for j in range(50))) for i in range(50)]
    found = rows(near.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")))
    assert all(c == 0 for d, c, _ in found if d < 1000)
    assert all(c == d and k for d, c, k in found if d >= 1000)


@pytest.mark.parametrize("repeat", [1, 3])
def test_similarity_equals_its_definition(repeat):
    draw = random.Random(repeat)
    for _ in range(20):
        a = [f"w{draw.randrange(12)}" for _ in range(40)] * repeat
        b = edited(draw, a, 3)
        a, b = " ".join(a), " ".join(b)
        expected = brute.probability_jaccard(brute.shingle_weights(a), brute.shingle_weights(b))
        assert abs(near.similarity(a.encode(), b.encode()) - expected) < 1e-9


def test_registers_agree_as_often_as_texts_are_similar():
    draw = random.Random(9)
    shares, truth = [], []
    for _ in range(40):
        a = [f"w{draw.randrange(10**6)}" for _ in range(120)] + ["again"] * 20
        b = edited(draw, a, 3)
        texts = [" ".join(a).encode(), " ".join(b).encode()]
        name, weight, owner, _ = near.shingles(texts)
        won = near.registers(name, weight, owner, 2)
        shares.append((won[0] == won[1]).mean())
        truth.append(near.similarity(*texts))
    assert abs(np.mean(shares) - np.mean(truth)) < 0.02


def test_edges(spark, rows):
    schema = "doc_id long, text string, d int, h int, root string, kept int"
    assert rows(near.near_duplicates(spark.createDataFrame([], schema))) == []
    text = "one two three four five six"
    data = [(5, text, 1, 1, "", 1), (5, text, 1, 1, "", 1), (None, text, 1, 1, "", 1)]
    data += [(7, None, 1, 1, "", 1), (8, "", 1, 1, "", 1), (None, "alone here", 1, 1, "", 1)]
    frame = spark.createDataFrame(data, schema)
    assert rows(near.near_duplicates(frame)) == [
        (5, 5, True), (5, 5, True), (7, 7, True), (8, 8, True), (None, 5, False), (None, None, True),
    ]
    kept = near.deduplicated_documents(frame)
    assert kept.columns == frame.columns
    assert rows(kept, "doc_id") == [(5,), (7,), (8,), (None,)]


def test_texts_with_one_short_hash_and_no_id_stay_apart(spark, rows):
    passage = " ".join(f"word{i}" for i in range(60))
    docs = [(None, f"{passage} x9556"), (None, "short y19362")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert frame.select(F.hash("text")).distinct().count() == 1
    assert rows(near.deduplicated_documents(frame), "text") == sorted((t,) for _, t in docs)
    # If an earlier row is a copy of one of them, only that one goes.
    more = spark.createDataFrame([(1, docs[0][1]), *docs], "doc_id long, text string")
    assert rows(near.deduplicated_documents(more), "doc_id", "text") == [(1, docs[0][1]), (None, docs[1][1])]


ROW = "struct<d:long,h:long>"


def number_links():
    """Texts are numbers; those two apart or nearer link.  (By value, for executors.)"""

    def screen(sketches, classes):
        return np.ones(len(sketches), bool)

    def compare(texts, sketches, classes):
        values = np.array([int(t) for t in texts])
        return blocks.spanning(np.abs(values[:, None] - values[None, :]) <= 2, classes)

    return screen, compare


@pytest.mark.parametrize("block, values", [(256, range(0, 900, 2)), (8, range(0, 900, 2)), (4, [1, 2, 3] * 30), (8, [])])
def test_all_documents_of_a_bucket_are_compared(spark, monkeypatch, block, values):
    monkeypatch.setattr(blocks, "BLOCK", block)
    draw = random.Random(block)
    values = [v for v in values if draw.random() < 0.8]
    members = [(v + i, (n, 0), 1) for n, v in enumerate(values) for i in range(3)]
    texts = [(n, 0, str(v)) for n, v in enumerate(values)]
    found = blocks.classes(
        spark.createDataFrame(members, f"bucket long, row {ROW}, size long"),
        spark.createDataFrame(texts, "d long, h long, text string"),
        spark.createDataFrame(texts, "d long, h long, sketch string").withColumn("sketch", F.col("sketch").cast("binary")),
        *number_links(),
    )
    roots = {r["node"]["d"]: r["root"]["d"] for r in found.collect()}
    forest = blocks.Forest(np.arange(len(values)))
    for i, v in enumerate(values):
        for j in range(i):
            if abs(v - values[j]) <= 2:
                forest.join(i, j)
    assert [roots.get(i, i) for i in range(len(values))] == [forest.root(i) for i in range(len(values))]


def test_blocks_of_one_class_are_not_compared_with_each_other(spark, monkeypatch):
    monkeypatch.setattr(blocks, "BLOCK", 16)
    rows = [(5, (i, 0), 1, (0, 0)) for i in range(1600)] + [(5, (i, 0), 1, (i, 0)) for i in range(1600, 1603)]
    unsettled = spark.createDataFrame(rows, f"bucket long, row {ROW}, size long, root {ROW}")
    zero = F.lit(0).cast("long")
    first = F.struct(zero.alias("d"), zero.alias("h"))
    in_group = unsettled.select("row", first.alias("group"), F.lit(101).alias("blocks"))
    placed = blocks._reblocked(unsettled, in_group)
    pairs = blocks._block_pairs(unsettled, placed, 0.0)
    of_class = placed.where("root.d = 0").select("block").distinct().count()
    # The strangers' one block meets itself and every block of the class.
    assert pairs.count() == of_class + 1 and of_class > 90


def test_a_large_group_puts_out_a_forest():
    """What leaves a task is at most one link for each document."""
    texts = [b"5"] * 200
    _, compare = number_links()
    assert len(list(compare(texts, texts, np.arange(200)))) == 199
    assert list(compare(texts, texts, np.zeros(200, int))) == []


def test_rows_that_share_id_and_text_leave_the_least(spark, rows):
    data = [(1, "a b", "z"), (1, "a b", "b"), (1, "a b", None), (2, "a  b", "c")]
    frame = spark.createDataFrame(data, "doc_id long, text string, `a.b c-d` string")
    kept = near.deduplicated_documents(frame.repartition(3))
    assert rows(kept) == rows(near.deduplicated_documents(frame)) == [(1, "a b", "b")]


def test_components_of_chains_and_stars(spark, rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    assert rows(components(frame)) == [(i, 0) for i in range(1, 41)] + [(100 + i, 100) for i in range(1, 50)]
    assert rows(components(frame.limit(0))) == []


def test_components_of_one_stretch_take_no_rounds_of_stars(spark, rows, monkeypatch):
    """Over many partitions, each round is thousands of tasks."""
    monkeypatch.setattr(graph, "_toward", lambda *_, **__: pytest.fail("a round of stars"))
    chain = [(i, i + 1) for i in range(500)]
    random.Random(4).shuffle(chain)
    frame = spark.createDataFrame(chain, "a long, b long").repartition(20)
    assert rows(components(frame)) == [(i, 0) for i in range(1, 501)]


@pytest.mark.parametrize("stretch", [3, 20, 1 << 15])
def test_components_of_random_graphs(spark, rows, monkeypatch, stretch):
    monkeypatch.setattr(graph, "EDGES", stretch)
    draw = random.Random(stretch)
    edges = [(draw.randrange(120), draw.randrange(120)) for _ in range(75)] + [(300, 200 + i) for i in range(40)]
    forest = blocks.Forest(np.arange(301))
    for a, b in edges:
        forest.join(a, b)
    expected = [(x, forest.root(x)) for x in range(301) if forest.root(x) != x]
    flat = spark.createDataFrame(edges, "a long, b long").repartition(3)
    assert rows(components(flat)) == expected
    # As structs: ordered by the first field, then by the second.
    split = lambda c: F.struct((F.col(c) / 10).cast("long").alias("d"), (F.col(c) % 10).alias("h"))
    found = components(flat.select(split("a").alias("a"), split("b").alias("b")))
    found = found.selectExpr("node.d * 10 + node.h AS node", "root.d * 10 + root.h AS root")
    assert rows(found) == expected
