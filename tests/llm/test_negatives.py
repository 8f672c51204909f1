"""Hard negatives against plain scores."""

import math
import random

import numpy as np
import pytest

from grainline.llm import negatives

ROWS = "vec_id long, embedding array<double>, label int"


def plain(data, scale=256):
    usable = {}
    for vec_id, x, label in data:
        if vec_id is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (label + 1) % 10 if vec_id % 7 == 0 else label
        row = (label, [math.floor(scale * c) for c in x])
        usable[vec_id] = min(usable.get(vec_id, row), row)
    out = []
    for a, (own, x) in usable.items():
        if a % 100:
            continue
        scored = sorted(
            (-sum(p * q for p, q in zip(x, y)), i, label == own) for i, (label, y) in usable.items() if i != a
        )
        for high, p, _ in [s for s in scored if s[2]][:5]:
            near = [s for s in scored if not s[2] and -80 * high <= -100 * s[0] <= -100 * high][:5]
            out += [(a, p, rank, i, -high, -low) for rank, (low, i, _) in enumerate(near, 1)]
    return sorted(out)


def found(frame):
    return sorted(map(tuple, negatives.mine(frame, negatives.shifted_label()).collect()))


@pytest.mark.parametrize("group, block", [(32_768, 64), (16, 2)])
def test_equals_plain_scores(spark, monkeypatch, group, block):
    monkeypatch.setattr(negatives, "GROUP", group)
    monkeypatch.setattr(negatives, "BLOCK", block)
    draw = random.Random(4)
    data = [(i, [draw.gauss(0.4, 0.4) for _ in range(11)], draw.choice([0, 1, 1, 2])) for i in range(0, 1500, 5)]
    # Ties: a third of the rows hold one vector.
    data = [(i, [0.5] * 11 if i % 3 == 0 else x, label) for i, x, label in data]
    assert len(plain(data)) > 50
    assert found(spark.createDataFrame(data, ROWS).repartition(6)) == plain(data)


def test_odd_rows(spark):
    data = [
        (0, [1.0, -2.0], 1), (100, [0.0, 0.0], 1), (200, [-1.0, 3.0], 1), (300, None, 1), (400, [1.0, None], 1),
        (500, [1.0, float("nan")], 1), (600, [float("inf"), 1.0], 1), (700, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
        (1, [1.0, -2.0], 2), (2, [0.9, -1.9], 3), (3, [1.0], 1), (3, [1.0], 1), (4, [], 2), (5, [1e6, -1e6, 7.0], 2),
    ]
    assert found(spark.createDataFrame(data, ROWS)) == plain(data)
    assert found(spark.createDataFrame([], ROWS)) == []
    assert found(spark.createDataFrame([(100, [1.0], 1)], ROWS)) == []


def test_further_columns_are_not_used(spark):
    data = [(i, [1.0 + i % 7, 2.0], i % 3, 1, 2, 3) for i in range(0, 300, 3)]
    frame = spark.createDataFrame(data, ROWS + ", ints int, number int, `packed.b c` int")
    assert found(frame) == plain([d[:3] for d in data])


def test_lookups_equal_products():
    draw = np.random.default_rng(3)
    for low, high, width in ((-3, 3, 1), (0, 1, 8), (-300, 255, 64), (-(2**40), 2**40, 13), (-1, 0, 9), (0, 0, 5)):
        rows, anchors = (draw.integers(low, high, (n, width), endpoint=True) for n in (37, 5))
        planes = negatives.planes_for(int(rows.min()), int(rows.max()))
        assert (negatives.scores(negatives.packed(rows, planes), anchors) == rows @ anchors.T).all()
