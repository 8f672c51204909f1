"""The Merkle manifest against a plain tree, and its witnesses."""

import zlib

import pytest
from brute import sha

from grainline.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def hashed(*parts):
    return sha("".join(parts))


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(doc, more=0):
    doc_id, text, lang, source, n_chars = doc[:5]
    n = None if n_chars is None else n_chars + more
    return hashed(*map(field, (doc_id, source, lang, n, text)))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([hashed(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, at):
    for level in tree[:-1]:
        yield (at ^ 1 < at, level[at ^ 1]) if at ^ 1 < len(level) else None
        at //= 2


def expected(docs):
    by_lang = {}
    for doc in docs:
        by_lang.setdefault(doc[2], []).append(doc)
    order = sorted(by_lang, key=lambda k: (k is not None, (k or "").encode()))
    for docs in by_lang.values():
        docs.sort(key=lambda d: (d[0] is None, d[0], leaf(d)))
    trees = {k: levels([leaf(d) for d in by_lang[k]]) for k in order}
    top = levels([trees[k][-1][0] for k in order])
    out, root = [], top[-1][0]
    for place, k in enumerate(order):
        for at, doc in enumerate(by_lang[k]):
            steps = [*siblings(trees[k], at), *siblings(top, place)]
            hit = doc[0] is not None and zlib.crc32(str(doc[0]).encode()) % 7 == 0
            end = leaf(doc, int(hit))
            for step in steps:
                end = hashed(end) if step is None else hashed(step[1], end) if step[0] else hashed(end, step[1])
            proof = hashed(*(s[1] for s in steps if s))
            out.append((doc[0], leaf(doc), trees[k][-1][0], root, proof, end, end == root))
    return sorted(out, key=lambda r: (r[0] is None, *r))


def found(frame):
    done = manifest.proved(manifest.witnesses(frame, manifest.tampered())).collect()
    return sorted(map(tuple, done), key=lambda r: (r[0] is None, *r))


ODD = [
    (None, "a", "en", "s", 1),
    (None, None, "en", None, None),
    (3, "", "en", "s", 0),
    (3, "", "en", "s", 0),
    (3, "other", "en", "s", 5),
    (11, "é🙂", None, "", 2),
    (-4, "x" * 300_000, "", "s", 300_000),
    (5, "y", "🙂", "s", 1),
    (6, "y", "zz", "s", None),
]


@pytest.mark.parametrize("height", [1, 2, 12])
def test_equals_a_plain_tree(spark, monkeypatch, height):
    monkeypatch.setattr(manifest, "HEIGHT", height)
    docs = ODD + [(100 + i, f"text {i % 9}", "de" if i % 3 else "en", "s", i) for i in range(61)]
    assert found(spark.createDataFrame(docs, DOCS).repartition(5)) == expected(docs)


def test_one_row_and_none(spark):
    one = [(1, "a", "en", "s", 1)]
    assert found(spark.createDataFrame(one, DOCS)) == expected(one)
    assert found(spark.createDataFrame([], DOCS)) == []


def test_further_columns_are_not_used(spark):
    docs = [(i, "t", "en", "s", i, 1, 2, 3, 4) for i in range(9)]
    frame = spark.createDataFrame(docs, DOCS + ", g int, pos int, digest int, `a.b c` int")
    assert found(frame) == expected(docs)


def test_a_witness_holds_for_its_leaf_alone(spark):
    rows = manifest.witnesses(spark.createDataFrame([(i, f"t{i}", "en", "s", i) for i in range(21)], DOCS)).collect()
    for one in rows:
        for two in rows:
            same = manifest.folded(two.leaf.encode(), bytes(one.witness)).decode() == one.root
            assert same == (one.leaf == two.leaf)


def test_closing_a_frontier_equals_the_levels():
    for n in range(1, 40):
        digests = [sha(str(i)) for i in range(n)]
        frontier = manifest.Frontier()
        for d in digests:
            frontier.append(d.encode())
        tree = levels(digests)
        assert frontier.close((n - 1).bit_length()).decode() == tree[-1][0]
        for i, path in enumerate(frontier.paths):
            assert [s.decode() for _, s in manifest.steps(bytes(path)) if s] == [s[1] for s in siblings(tree, i) if s]
