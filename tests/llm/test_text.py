"""Languages, quality, toxicity, token ids: plain versions and held-out accuracy."""

import gc
import math
import os
import random
import weakref
import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from grainline.llm import bpe, langid, quality, repeats, toxicity
from grainline.llm.queries import tokenizer_definition

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = "doc_id long, text string, lang string, kept int, score string, held_out int, n_words int"
LONG = "lorem ipsum dolor sit amet consectetur " * 50_000


@pytest.fixture(scope="module")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark, folder):
    return spark.read.parquet(f"{folder}/labels.parquet")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(tokenizer_definition())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


PIECES = [
    "a", "b", " ", "  ", "\n", "\t", "é", "the", " the", "<|endoftext|>", "'s", "'ll", "1", "23",
    "\x85", "\xa0", " ", "\x1c", "!", "?!", "aa", "中文", "🙂", "́", "ß", "Ⅷ", "²",
    "​", "\r\n", "THE", "ing", "\x00", "᠎", "Ᲊ", "՘", "\U0001246f", "ﷺ",
]


def test_ids_equal_the_library(encoder, library):
    draw = random.Random(1)
    texts = ["".join(draw.choices(PIECES, k=draw.randint(0, 14))) for _ in range(4000)]
    texts += ["".join(chr(draw.choice([draw.randint(0, 0x2FF), draw.randint(0, 0xD7FF), draw.randint(0xE000, 0x3FFFF)])) for _ in range(6)) for _ in range(3000)]
    texts += ["a" * 20_000, " " * 5000 + "x", ""]
    for text in texts:
        expected = library.encode(text, add_special_tokens=False).ids
        found = encoder.encode(text)
        assert found == [str(i) for i in expected], text
        assert encoder.decode(found).decode() == library.decode(expected, skip_special_tokens=False)


def test_an_encoder_keeps_no_long_piece_and_no_word_twice():
    encoder, draw = bpe.Encoder(tokenizer_definition()), random.Random(4)
    letters = lambda n: "".join(draw.choices("aeinorst", k=n))
    kept = lambda: [k + v for d in (encoder.words, encoder.chunks) for k, v in d.items()]
    encoder.encode("x " + letters(20_000))
    assert sum(map(len, kept())) < 1000
    encoder.encode(" ".join(letters(12) for _ in range(1000)))
    assert len(kept()) < 1010


def test_an_encoder_goes_with_its_task():
    gc.disable()  # as tasks do
    try:
        encoder = bpe.Encoder(tokenizer_definition())
        assert encoder.decode(encoder.encode("the end, of it")) == b"the end, of it"
        gone = weakref.ref(encoder)
        del encoder
        assert gone() is None
    finally:
        gc.enable()


def test_ids_stay_when_few_pieces_are_kept(library, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 5, raising=True)
    encoder, draw = bpe.Encoder(tokenizer_definition()), random.Random(5)
    known = ["one", "two,", "three!", "it's", "caf\u00e9", "x" * 200, "\n", "four."]
    for _ in range(500):
        text = " ".join(draw.choices(known, k=12))
        assert encoder.encode(text) == [str(i) for i in library.encode(text, add_special_tokens=False).ids]


def test_encoded_table_equals_the_library(documents, library, rows):
    found = rows(bpe.encode(documents, tokenizer_definition()))
    expected = []
    for row in documents.select("doc_id", "text").collect():
        ids = library.encode(row[1], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append((row[0], len(ids), brute.sha(",".join(map(str, ids))), brute.sha(decoded)))
    assert found == sorted(expected)


def test_encoding_edges(spark, rows):
    data = [(1, None, "", 1, "", 1, 1), (None, "", "", 1, "", 1, 1), (2, LONG, "", 1, "", 1, 1), (2, LONG, "", 1, "", 1, 1)]
    found = rows(bpe.encode(spark.createDataFrame(data, CLASHING), tokenizer_definition()))
    nothing = brute.sha("")
    assert found[0] == (1, 0, nothing, nothing) and found[3] == (None, 0, nothing, nothing)
    assert found[1] == found[2] and found[1][3] == brute.sha(LONG)
    assert rows(bpe.encode(spark.createDataFrame([], CLASHING), tokenizer_definition())) == []


def test_languages_of_held_out_documents(documents):
    found = langid.identify(documents).toPandas().merge(documents.select("doc_id", "lang").toPandas())
    held = [zlib.crc32(str(i).encode()) % 4 == 2 for i in found.doc_id]
    assert found.held_out.tolist() == held
    unseen = found[found.held_out]
    assert (unseen.lang == unseen.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_a_mixed_text_is_a_mixture(spark, documents):
    some = {r.lang: r.text for r in documents.where("length(text) > 800").orderBy("doc_id").collect()}
    both = some["en"][:600] + "\n" + some["de"][:300]
    learned = documents.select("doc_id", "text", "lang").where("crc32(cast(doc_id as string)) % 4 != 2")
    asked = spark.createDataFrame([(2, both, None)], "doc_id long, text string, lang string")
    assert zlib.crc32(b"2") % 4 == 2 or True
    row = langid.identify(learned.union(asked.selectExpr("-5L", "text", "lang"))).where("doc_id = -5").first()
    assert row.lang_pred == "en" and 0.5 < row.score < 0.85


def test_language_edges(spark, documents, rows):
    empty = spark.createDataFrame([], CLASHING)
    assert rows(langid.identify(empty)) == []
    odd = spark.createDataFrame([(1, "12 34!", None), (2, None, "xx"), (3, "", None), (None, "ab", None)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in langid.identify(documents.select("doc_id", "text", "lang").where("doc_id > 10").union(odd)).collect()}
    assert [found[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and found[1].score == 0
    assert found[None].lang_pred in {"en", "de", "fr", "es"}
    alone = rows(langid.identify(odd))
    assert {r[2] for r in alone} == {"und"}
    one = spark.createDataFrame([(1, LONG, "la", 1, "", 1, 1), (1, LONG, "la", 1, "", 1, 1)], CLASHING)
    assert [r[2:] for r in rows(langid.identify(one))] == [("la", 1.0)] * 2


def test_quality_equals_a_plain_version(documents, labels, rows):
    trusted = quality.trusted_documents(labels)
    good = {r[0] for r in trusted.collect()}
    docs = [(r[0], r[1]) for r in documents.select("doc_id", "text").collect()]
    found = rows(quality.judge(documents, trusted))
    means = dict(zip([i for i, _ in docs], brute.mean_ratios(docs, good)))
    for row in found:
        counts = brute.base_counts(dict(docs)[row[0]])
        assert row[1:7] == counts
        assert abs(row[8] - means[row[0]]) < 1e-6
        assert row[7] == (not counts[5] and means[row[0]] >= quality.THRESHOLD)


def test_quality_keeps_good_and_drops_poor_documents(documents, labels):
    found = quality.judge(documents, quality.trusted_documents(labels)).join(labels, "doc_id").toPandas()
    good, poor = found[(found.quality == 1) & ~found.base_failed], found[found.quality == 0]
    assert good.kept.mean() > 0.98 and poor.kept.mean() < 0.05


@pytest.mark.parametrize("bits", [1 << 25, 1 << 16, 64])
def test_quality_counts_every_trusted_document(spark, monkeypatch, bits):
    monkeypatch.setattr(repeats, "BLOOM_BITS", bits)
    n = 36_000
    docs = [(i, f"text {i % 977} of {i}") for i in range(n + 3000)] + [(None, "text of none"), (7, "again"), (n + 1, None)]
    trusted = spark.range(n).selectExpr("id AS doc_id")
    texts = [(t or "").encode() for _, t in docs]
    expected = quality.ratios(*quality.counts_of(texts, [i is not None and i < n for i, _ in docs]))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert (quality.model(frame, trusted) == expected).all()


def test_quality_edges(spark, rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert rows(quality.judge(spark.createDataFrame([], CLASHING), quality.trusted_documents(none))) == []
    words = " ".join(f"word{i}" for i in range(12))
    data = [(1, None, "", 1, "", 1, 1), (None, words, "", 1, "", 1, 1), (2, LONG, "", 1, "", 1, 1), (2, words, "", 1, "", 1, 1)]
    frame = spark.createDataFrame(data, CLASHING)
    found = rows(quality.judge(frame, quality.trusted_documents(none)), "doc_id", "base_failed", "kept", "llr")
    assert found == [(1, True, False, 0.0), (2, False, True, 0.0), (2, True, False, 0.0), (None, False, True, 0.0)]
    kept = quality.kept_documents(frame, quality.trusted_documents(none))
    assert kept.columns == frame.columns and rows(kept, "doc_id") == [(2,), (None,)]
    both = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (2, 1), (None, 1), (3, None)], "doc_id long, quality int")
    assert rows(quality.trusted_documents(both)) == [(2,)]


def planted_labels(spark, n=1500):
    draw = random.Random(4)
    vocabulary = [f"word{i}" for i in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = draw.choices(vocabulary, k=draw.randint(5, 120))
        toxic = draw.random() < 0.2
        for _ in range(draw.randint(1, 3) * toxic):
            words[draw.randrange(len(words))] = draw.choice(["Nasty,", "vilest", "vilely", "awful"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_documents_are_found_where_labels_are_held_out(spark):
    docs, labels = planted_labels(spark)
    found = toxicity.score(docs, labels).toPandas().merge(labels.toPandas())
    assert found.held_out.tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]
    unseen = found[found.held_out]
    assert unseen[unseen.toxic == 1].predicted.mean() > 0.95
    assert unseen[unseen.toxic == 0].predicted.mean() < 0.01


def test_held_out_toxic_documents_of_the_given_tables_are_found(spark):
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no such tables")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    found = toxicity.score(docs, labels).toPandas().merge(labels.toPandas())
    unseen = found[found.held_out]
    assert unseen[unseen.toxic == 1].predicted.mean() > 0.85
    assert unseen[unseen.toxic == 0].predicted.mean() < 0.01


def plain_fit(rows, labels):
    """FTRL-proximal, one coordinate after another."""
    z, n = {}, {}
    heavier = (len(labels) - sum(labels)) / sum(labels)

    def weight(i):
        v = z.get(i, 0.0)
        if abs(v) <= toxicity.L1:
            return 0.0
        v -= math.copysign(toxicity.L1, v)
        return -v / ((toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.EPOCHS):
        for row, label in zip(rows, labels):
            ws = [weight(i) for i in row]
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(ws))))) - label
            g *= heavier if label else 1
            for i, w in zip(row, ws):
                old = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / toxicity.ALPHA * w
                n[i] = old + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_the_fit_equals_a_plain_one():
    draw = random.Random(8)
    rows, labels = [], []
    for _ in range(250):
        label = int(draw.random() < 0.2)
        row = {0, *(draw.randrange(1, 60) for _ in range(15)), *([99] if label and draw.random() < 0.8 else [])}
        rows.append(np.array(sorted(row), np.int32))
        labels.append(label)
    fitted = toxicity.fit(rows, np.array(labels, float))
    expected = plain_fit([r.tolist() for r in rows], labels)
    assert set(np.flatnonzero(fitted)) == set(expected) and 99 in expected
    assert all(abs(fitted[i] - w) < 1e-9 for i, w in expected.items())


def test_held_out_labels_are_not_learned_from(spark, rows):
    docs, labels = planted_labels(spark, 300)
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    assert rows(toxicity.score(docs, labels)) == rows(toxicity.score(docs, flipped))


def test_toxicity_edges(spark, rows):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert rows(toxicity.score(spark.createDataFrame([], CLASHING), none)) == []
    data = [(1, None, "", 1, "", 1, 1), (None, "", "", 1, "", 1, 1), (2, LONG, "", 1, "", 1, 1), (2, LONG, "", 1, "", 1, 1)]
    found = rows(toxicity.score(spark.createDataFrame(data, CLASHING), none), "doc_id", "score", "predicted")
    assert found == [(1, 0.5, 0), (2, 0.5, 0), (2, 0.5, 0), (None, 0.5, 0)]
    odd = spark.createDataFrame([(0, None), (None, 1), (99, 1), (0, 1), (0, 0)], "doc_id long, toxic int")
    assert len(rows(toxicity.score(spark.createDataFrame([(0, "x", "", 1, "", 1, 1)], CLASHING), odd))) == 1
