"""Chat turns, mixtures, exact search, and the pipeline."""

import json
import math
import random
from collections import defaultdict

import brute
import pytest
from compare import difference, duckdb_on

from grainline.llm import chat, mixing, topk
from grainline.llm.queries import QUERIES
from grainline.llm.statements import STATEMENTS

TURNS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_queries_equal_their_statements(spark, folder, name):
    connection = duckdb_on(folder)
    assert difference(QUERIES[name](spark, folder), connection, STATEMENTS[name])[0] == ""


# Chat


def digest_of(turns):
    said = [t or "" for r, t in turns if r == "assistant"]
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    return len(turns), brute.sha(whole), sum(map(len, said)), brute.sha("".join(said))


NASTY = ["<|im_end|>", r"<\|im_start|>", r"<\\|x", "<", "|", "\\", "\n", "assistant\n", "", None, "é🙂", "<|"]


def test_texts_with_control_strings_are_read_back(spark, rows):
    draw = random.Random(2)
    data, expected = [], {}
    for conv in [*range(40), None]:
        turns = []
        for turn in range(draw.randint(1, 6)):
            role = draw.choice(["user", "assistant", "system", "we\\ird\nrole", "<|im_end|>", None])
            text = "".join(x or "" for x in draw.choices(NASTY, k=4)) if draw.random() < 0.9 else None
            turns.append((role, text))
            data.append((conv, turn, role, text))
        expected[conv] = digest_of(turns)
    draw.shuffle(data)
    frame = spark.createDataFrame(data, TURNS).repartition(5)
    formatted = chat.format_turns(chat.turns_of(frame))
    found = {r[0]: r[1:5] for r in rows(chat.digests(formatted))}
    assert found == expected
    for r in formatted.collect():
        assert r.piece.count("<|") == 2 and r.piece.endswith("<|im_end|>\n")
        assert chat.read_piece(r.piece) == (r.role or "", r.text or "")


def test_chat_edges(spark, rows):
    assert rows(chat.digests(chat.format_turns(chat.turns_of(spark.createDataFrame([], TURNS))))) == []
    wide = spark.createDataFrame(
        [(1, 0, "user", "b", "x", 1), (1, 0, "user", "a", "x", 1), (1, 0, "user", "a", "x", 1), (1, None, "assistant", "z" * 10**6, "x", 1)],
        TURNS + ", piece string, messages int",
    )
    ((conv, *rest),) = rows(chat.digests(chat.format_turns(chat.turns_of(wide))))
    assert conv == 1
    assert tuple(rest[:4]) == digest_of([("assistant", "z" * 10**6), ("user", "a"), ("user", "a"), ("user", "b")])
    with pytest.raises(ValueError, match="no mapping"):
        chat.turns_of(spark.range(1).withColumnRenamed("id", "other"))


RECORDS = [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]}, "messages", [("user", "q"), ("assistant", "a")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]}, "from_value", [("user", "q"), ("assistant", "a")]),
    ({"instruction": "do", "input": "this", "output": "done"}, "instruction", [("user", "do\nthis"), ("assistant", "done")]),
    ({"instruction": "do", "output": "done", "system": "be"}, "instruction", [("system", "be"), ("user", "do"), ("assistant", "done")]),
    ({"prompt": "p", "completion": None}, "prompt", [("user", "p"), ("assistant", "")]),
    ({"question": "q", "answer": 4, "more": {"x": [1]}}, "question", [("user", "q"), ("assistant", "4")]),
]


def test_layouts_become_turns(spark, rows):
    data = [(i, json.dumps(r)) for i, (r, _, _) in enumerate(RECORDS)]
    data += [(90, None), (91, "[1]"), (92, "{"), (93, json.dumps({"unknown": 1}))]
    found = defaultdict(list)
    for conv, layout, _, role, text in rows(chat.turns_of_json(spark.createDataFrame(data, "conv_id long, record string"))):
        found[conv].append((layout, role, text))
    for i, (_, layout, turns) in enumerate(RECORDS):
        assert found[i] == [(layout, r, t) for r, t in turns]
    assert all(found[i] == [(None, None, None)] for i in (90, 91, 92, 93))


def test_tables_of_other_layouts_become_turns(spark, rows):
    listed = spark.createDataFrame([(1, [("human", "q"), ("gpt", "a")])], "conv_id long, conversations array<struct<from:string,value:string>>")
    assert rows(chat.turns_of(listed)) == [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    flat = spark.createDataFrame([(1, "do", "x", "done"), (2, "do", None, "done")], "conv_id long, instruction string, input string, output string")
    assert rows(chat.turns_of(flat)) == [
        (1, 0, "user", "do\nx"), (1, 1, "assistant", "done"), (2, 0, "user", "do"), (2, 1, "assistant", "done"),
    ]


# Mixing


def sources(spark, sizes, seed=1):
    draw = random.Random(seed)
    data = []
    for name, n in sizes.items():
        for _ in range(n):
            data.append((len(data), " ".join(["w"] * draw.randint(1, 30)), name))
    return spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)


@pytest.mark.parametrize("repetition, entropy", [(2.0, 0.95), (1.2, 1.0), (5.0, 1.0), (2.0, 0.0)])
def test_draws_keep_to_their_budgets(spark, repetition, entropy):
    docs = sources(spark, {"big": 900, "mid": 200, None: 60, "tiny": 15})
    mix = mixing.Mix(entropy=entropy, repetition=repetition, block=32)
    drawn = mixing.mixture(docs, mix).toPandas().fillna({"source": "-"})
    tokens = docs.selectExpr("doc_id", "coalesce(source, '-') AS source", "size(split(text, ' ')) AS n").toPandas()
    total = tokens.n.sum()
    weights = drawn.groupby("source").weight.first()
    assert abs(weights.sum() - 1) < 1e-6
    for source, own in tokens.groupby("source"):
        mine = drawn[drawn.source == source]
        budget = int(weights[source] * total + 1e-4)
        assert mine.n_tokens.sum() <= budget
        assert budget - mine.n_tokens.sum() < 31
        counts = mine.groupby("doc_id").size().reindex(own.doc_id, fill_value=0)
        assert counts.max() - counts.min() <= 1
        assert counts.max() <= -(-budget // own.n.sum())
        assert budget / own.n.sum() <= repetition + 1e-3
    if entropy == 0.0:
        shares = tokens.groupby("source").n.sum() / total
        assert all(abs(weights[s] - shares[s]) < 1e-6 for s in weights.index)


def plain_exponent(tokens, mix):
    """The exponent by a fine grid, in plain numbers."""
    total = sum(tokens)

    def at(a):
        powered = [(t / total) ** a for t in tokens]
        weights = [p / sum(powered) for p in powered]
        passes = max(w * total * mix.budget / t for w, t in zip(weights, tokens))
        return -sum(w * math.log(w) for w in weights), passes

    own = at(1.0)[0]
    target = own + mix.entropy * (math.log(len(tokens)) - own)
    grid = [i / 20000 for i in range(20001)]
    a = max(x for x in grid if at(x)[0] >= target - 1e-12)
    return a if at(a)[1] <= mix.repetition else min(x for x in grid if x >= a and at(x)[1] <= mix.repetition)


@pytest.mark.parametrize("mix", [mixing.Mix(), mixing.Mix(entropy=0.9, repetition=1.1)])
def test_a_whole_table_is_mixed_as_a_plain_version_says(spark, folder, mix):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    counts = mixing.token_counts(docs)
    by_source = mixing.by_source(counts).toPandas().set_index("source")
    a = mixing.exponent(mixing.by_source(counts), mix)
    assert a < 1 and abs(a - plain_exponent(list(by_source.tokens), mix)) < 1e-4
    total = by_source.tokens.sum()
    powered = (by_source.tokens / total) ** a
    drawn = mixing.mixture(docs, mix).toPandas()
    realised = drawn.groupby("source").n_tokens.sum()
    longest = counts.agg({"n_tokens": "max"}).first()[0]
    assert ((powered / powered.sum() * total - realised).abs() <= longest).all()
    times = drawn.groupby("doc_id").size()
    # Small sources are repeated, large ones cut.
    assert times.max() == 2 and len(times) < docs.count()


def test_mixing_does_not_depend_on_the_layout(spark, rows):
    docs = sources(spark, {"a": 100, "b": 30})
    mix = mixing.Mix(block=16)
    once = rows(mixing.mixture(docs, mix))
    assert once == rows(mixing.mixture(docs.repartition(7), mix)) != []
    wide = docs.selectExpr("*", "1 AS _block", "2 AS block", "3 AS weight", "4 AS s")
    out = mixing.mixed_documents(wide, mix)
    assert out.columns == wide.columns
    assert sorted(r[0] for r in rows(out, "doc_id")) == sorted(r[0] for r in once)


def test_mixing_edges(spark, rows):
    schema = "doc_id long, text string, source string, tokens int"
    assert rows(mixing.mixture(spark.createDataFrame([], schema))) == []
    nothing = spark.createDataFrame([(1, None, "a", 1), (2, "", "b", 1), (None, None, None, 1)], schema)
    assert rows(mixing.mixture(nothing)) == []
    data = [(1, "x y", "a", 1), (1, "x y", "a", 1), (None, "z " * 200_000, None, 1), (3, None, "c", 1)]
    found = rows(mixing.mixture(spark.createDataFrame(data, schema), mixing.Mix(entropy=0.0)))
    assert [r[0] for r in found] == [1, 1, None]


# Exact search


def vectors(spark, data):
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").repartition(3)


def test_search_equals_a_plain_version(spark, rows, monkeypatch):
    draw = random.Random(3)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 2)
    monkeypatch.setattr(topk, "SHARD", 40)
    data = [(i, [draw.choice([-0.5, 0.0, 0.25, draw.random()]) for _ in range(6)], 0) for i in range(450)]
    data = [(i, v, n) if i % 5 else (i, [0.5] * 6, n) for i, v, n in data]
    data += [(500, None, 0), (600, [1.0, None], 0), (700, [float("nan")] * 6, 0), (-100, [float("inf")], 0)]
    found = topk.search(vectors(spark, data))
    exact = [(i, v) for i, v, _ in vectors(spark, data).collect()]
    assert rows(found) == sorted(brute.top_k(exact))


def test_search_edges(spark, rows):
    assert rows(topk.search(vectors(spark, []))) == []
    assert rows(topk.search(vectors(spark, [(0, [1.0], 0)]))) == []
    assert rows(topk.search(vectors(spark, [(1, [1.0], 0), (2, [1.0], 0)]))) == []
    data = [(0, [1.0, 1.0], 0), (3, [2.0], 0), (2, [2.0, 0.0, 9.0], 0), (5, [], 0), (2, [2.0, 0.0, 9.0], 0), (None, [1.0], 0)]
    one = 1024 * 2048
    assert rows(topk.search(vectors(spark, data))) == [(0, 1, 2, one), (0, 2, 2, one), (0, 3, 3, one), (0, 4, 5, 0)]
    large = [(0, [2.0**18, 1.0], 0), (1, [2.0**18, 1.0], 0)]
    assert rows(topk.search(vectors(spark, large))) == [(0, 1, 1, 2**56 + 2**20)]


# Pipeline


def test_pipeline_equals_plain_stages(spark, folder, rows):
    """Each stage on its own input; mixing is held to its budgets above."""
    pipeline = pytest.importorskip("corpus_pipeline")
    stages = dict(pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").toPandas()
    trusted = set(labels[labels.quality == 1].doc_id)
    plain = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]

    kept = stages["quality rules"](spark, docs, folder)
    means = brute.mean_ratios(plain, trusted)
    good = [d for d, m in zip(plain, means) if not brute.base_counts(d[1])[5] and m >= -0.3]
    assert kept.columns == docs.columns and rows(kept, "doc_id") == sorted((i,) for i, _ in good)

    single = stages["near duplicates"](spark, kept, folder)
    first = {i for i, c in brute.classes(good) if i == c}
    assert single.columns == docs.columns and rows(single, "doc_id") == sorted((i,) for i in first)

    cut = stages["repeated passages"](spark, single, folder)
    words = {i: k for i, _, k in brute.kept_words([d for d in good if d[0] in first])}
    assert cut.columns == docs.columns
    assert {r.doc_id: brute.WORD.findall(r.text) for r in cut.collect()} == words

    mixed = stages["source mixture"](spark, cut, folder)
    assert mixed.columns == docs.columns and {i for (i,) in rows(mixed, "doc_id")} <= first

    ids = rows(stages["token ids"](spark, mixed, folder))
    assert rows(pipeline.run(spark, folder)) == ids
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert all(brute.sha(texts[i]) == decoded for i, _, _, decoded in ids)
