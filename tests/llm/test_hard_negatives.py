import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from shoalcast.llm import hard_negatives


def brute(rows):
    """The contract, every score by whole numbers: rows of (vec_id, vector, label)."""
    part = []
    for vec, x, label in rows:
        if label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        if vec is not None and vec % 7 == 0:
            label = (label + 1) % 10
        part.append((vec, [math.floor(256 * c) for c in x], label))
    out = []
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for k, (vec, q, label) in enumerate(part):
        if vec is None or vec % 50:
            continue
        scores = [(sum(a * b for a, b in zip(q, o)), v, lab, j) for j, (v, o, lab) in enumerate(part)]
        positives = sorted((s for s in scores if s[2] == label and s[3] != k), key=order)[:5]
        for p in positives:
            some = sorted((s for s in scores if s[2] != label and 50 * p[0] <= 100 * s[0] <= 95 * p[0]), key=order)[:3]
            out += [(vec, p[1], i + 1, s[1], p[0], s[0]) for i, s in enumerate(some)]
    return sorted(out, key=str)


def result(spark, rows, parts=5):
    frame = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, key int, cell int").repartition(parts)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted((tuple(r) for r in hard_negatives.mine(frame, label, F.col("vec_id") % 50 == 0).collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 10))
    rows = []
    for i in range(900):
        x = centres[rng.integers(12)] + rng.normal(size=10) * 0.4
        rows.append((i, [float(np.float32(c)) for c in x / np.linalg.norm(x)], int(rng.integers(10))))
    rows += [(1000 + i, rows[3][1], rows[3][2] if i % 3 else 9) for i in range(200)]  # a hot vector
    rows += [(50, rows[5][1], 4), (50, rows[50][1], rows[50][2]), (None, rows[6][1], 4), (3001, None, 3), (3002, [], 3), (3050, [0.0] * 10, 2)]
    rows += [(3003, [0.5, None] + [0.0] * 8, 3), (3004, [float("nan")] * 10, 3), (3005, [float("inf")] * 10, 3), (3006, rows[1][1], None), (3100, [1.0, 0.5], 3), (3007, [-0.3] * 14, 3)]
    random.Random(1).shuffle(rows)
    return rows


def test_equal_brute_force(spark, rows):
    expected = brute(rows)
    assert len(expected) > 100
    assert result(spark, rows) == expected


def test_small_chunks_and_blocks_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 6)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 40)
    assert result(spark, rows[:500], 2) == brute(rows[:500])


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4) * 2e5], int(rng.integers(3))) for i in range(300)]
    assert result(spark, rows) == brute(rows)


def test_cells_come_by_falling_bound_and_the_walk_stops_early():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(16, 8)) * 200
    rows = np.floor(centres[rng.integers(16, size=4000)] + rng.normal(size=(4000, 8)) * 3)
    books = hard_negatives.codebook(rows[:500, :4], 16), hard_negatives.codebook(rows[:500, 4:], 16)
    index = hard_negatives.Index(np.arange(4000), np.zeros(4000, np.int64), rows, books)
    one, two = index.half_bounds(rows[:1])
    bounds = [b for b, _ in index.walk(one[0], two[0])]
    assert bounds == sorted(bounds, reverse=True) and len(bounds) == len(index.spans)
    for bound, (a, b) in index.walk(one[0], two[0]):
        assert (index.rows[a:b] @ rows[0]).max() <= bound
    first, seen = hard_negatives.First(5), 0
    for at in index.batches(one[0], two[0], first.closed):
        first.add(index.scores(rows[0], at), index.ids[at])
        seen += len(at)
    assert seen < 2000
    best = np.sort(rows @ rows[0])[::-1][:5]
    assert (first.score == best).all()


def test_padding_and_saturation():
    got = hard_negatives.scaled(pa.array([[1.0], [1e300, -1e300], []]), 2)
    assert got.tolist() == [[256.0, 0.0], [2.0**28, -(2.0**28)], [0.0, 0.0]]


def test_empty_and_all_unusable(spark):
    assert result(spark, []) == []
    assert result(spark, [(50, None, 1), (100, [0.1], None)]) == []
