"""Plain versions of the operators, over lists of rows in one process."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text: str | bytes) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def order(doc_id):
    return 2**63 - 1 if doc_id is None else doc_id


def kept_words(docs):
    """(doc_id, words, kept) with 50-word windows of documents with a smaller id removed."""
    first, out = {}, []
    words = [(i, WORD.findall(t or "")) for i, t in docs]
    for i, w in words:
        for k in range(len(w) - 49):
            key = tuple(w[k : k + 50])
            first[key] = min(first.get(key, order(i)), order(i))
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < order(i):
                gone[k : k + 50] = [True] * 50
        out.append((i, w, [x for x, g in zip(w, gone) if not g]))
    return out


def substring(docs):
    return [(i, len(w), len(w) - len(k), sha(" ".join(k))) for i, w, k in kept_words(docs)]


def suffixes(docs):
    """100-byte strings that start earlier removed; rows have distinct ids."""
    first, texts, out = {}, sorted((order(i), (t or "").encode()) for i, t in docs), []
    for i, t in texts:
        for k in range(len(t) - 99):
            first.setdefault(t[k : k + 100], (i, k))
    for i, t in texts:
        gone = bytearray(len(t))
        for k in range(len(t) - 99):
            if first[t[k : k + 100]] != (i, k):
                gone[k : k + 100] = b"\1" * 100
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((None if i == order(None) else i, len(t), sum(gone), spans, sha(kept)))
    return out


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = defaultdict(list)
    for k in range(len(words) - 4):
        windows[tuple(words[k : k + 5])].append(k)
    repeat = {k + i for at in windows.values() if len(at) > 1 for k in at for i in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        dup,
        len(repeat),
        n < 10 or 100 * len(repeat) > 20 * n,
    )


def mean_ratios(docs, trusted, buckets=65536, unit=1 << 20):
    """Mean log ratio of each text's four-byte grams, counted one by one."""

    def grams(text):
        data = (text or "").encode()
        return [
            (int.from_bytes(data[k : k + 4], "little") * 2654435761 % 2**32) >> 16
            for k in range(len(data) - 3)
        ]

    raw, good = Counter(), Counter()
    for i, t in docs:
        raw.update(grams(t))
        if i in trusted:
            good.update(grams(t))
    n_raw, n_good = sum(raw.values()) + buckets, sum(good.values()) + buckets

    def ratio(g):
        if n_good == buckets:
            return 0
        return round((math.log((good[g] + 1) / n_good) - math.log((raw[g] + 1) / n_raw)) * unit)

    out = []
    for _, t in docs:
        own = grams(t)
        out.append(sum(map(ratio, own)) / unit / max(1, len(own)))
    return out


def shingle_weights(text):
    words = WORD.findall(text or "")
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def probability_jaccard(a, b):
    total = 0.0
    for i in a.keys() & b.keys():
        total += 1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in a.keys() | b.keys())
    return total


def classes(docs, similar=0.8):
    """Smallest id of each document's class, by comparing all pairs."""
    rows = sorted((order(i), t) for i, t in docs)
    weights = [shingle_weights(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = weights[x], weights[y]
            if a and b and (a == b or (a.keys() & b.keys() and probability_jaccard(a, b) >= similar - 1e-12)):
                low, high = sorted((find(x), find(y)))
                root[high] = low
    return [(rows[x][0], rows[find(x)][0]) for x in range(len(rows))]


def top_k(vectors, k=10, every=100):
    ints = [
        (i, [math.floor(1024 * x) for x in v])
        for i, v in vectors
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in ints:
        if q % every == 0:
            scored = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in ints if i != q]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out
