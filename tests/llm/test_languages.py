"""Language mixtures against a plain version, text by text."""

import math
import re
import zlib
from collections import Counter

import pytest

from grainline.llm import langid


def plain_words(text):
    """Buckets of the four-byte grams that start in each word."""
    low = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in text.encode())
    low += b" " * 4
    out = []
    for word in re.finditer(rb"[^ ]+", low):
        grams = (int.from_bytes(low[i : i + 4], "little") for i in range(word.start(), word.end()))
        out.append([(g * 2654435761 % 2**32) >> 16 for g in grams])
    return out


def plain_model(docs):
    counts = {}
    for doc_id, text, lang in docs:
        known = "" if doc_id is None else str(doc_id)
        if lang is None or text is None or zlib.crc32(known.encode()) % 4 == 2:
            continue
        counts.setdefault(lang, Counter()).update(b for w in plain_words(text) for b in w)
    model = {}
    for lang, count in counts.items():
        total = sum(count.values()) + 0.5 * langid.BUCKETS
        model[lang] = lambda b, count=count, total=total: round(math.log((count[b] + 0.5) / total) * langid.SCALE)
    return {k: model[k] for k in sorted(model)}


def expectation(likely, langs):
    """Shares of `langs` after the steps, and the penalised likelihood."""
    share = {x: 1 / len(langs) for x in langs}
    top = [max(u.values()) for u in likely]
    p = [{x: math.exp(u[x] - t) for x in langs} for u, t in zip(likely, top)]
    for _ in range(langid.STEPS):
        new = dict.fromkeys(langs, 0.0)
        for u in p:
            whole = max(sum(u[x] * share[x] for x in langs), 1e-300)
            for x in langs:
                new[x] += u[x] * share[x] / whole
        share = {x: v / len(p) for x, v in new.items()}
    fit = sum(math.log(max(sum(u[x] * share[x] for x in langs), 1e-300)) for u in p) + sum(top)
    return share, fit - langid.PENALTY * len(langs) * math.log(len(p) + 1)


def plain_language(text, model):
    words = plain_words(text or "")
    if not words or not re.search(r"[^\W\d_]", text):
        return "und", 0.0
    units = [sum(words[i : i + 4], []) for i in range(0, len(words), 4)]
    likely = [{x: sum(map(f, u)) / langid.SCALE for x, f in model.items()} for u in units]
    langs, best = list(model), (-math.inf, None)
    first = True
    while True:
        share, value = expectation(likely, langs)
        if value > best[0]:
            best = value, share
        if len(langs) == 1:
            break
        low = [x for x in langs if share[x] < 0.02 and share[x] < max(share.values())] if first else []
        first = False
        for x in low or [min(langs, key=lambda x: share[x])]:
            langs.remove(x)
    name = max(sorted(best[1]), key=lambda x: best[1][x])
    return name, min(1.0, best[1][name])


def test_a_whole_table_equals_a_plain_version(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    rows = [tuple(r) for r in docs.collect()]
    model = plain_model(rows)
    found = {r["doc_id"]: r for r in langid.identify(docs).collect()}
    assert len(found) == len(rows) and len(model) > 2
    for doc_id, text, _ in rows:
        name, score = plain_language(text, model)
        assert found[doc_id]["lang_pred"] == name
        assert found[doc_id]["score"] == pytest.approx(score, abs=1e-6)
