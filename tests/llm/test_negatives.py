"""Hard negatives against brute force: windows, ties, repeats, bounds that never cut a pair."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from chatterscope.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, at string, key string"


def expected(rows, every=10, positives=5, most=5, percent=80):
    """Rows (vec_id, embedding, label): the result by comparing each anchor with all rows."""
    usable = set()
    for i, v, label in rows:
        if i is None or v is None or label is None:
            continue
        if any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.add((i, label, tuple(int(np.floor(256 * x)) for x in v)))
    out = []
    for anchor in usable:
        if anchor[0] % every:
            continue
        scores = defaultdict(set)
        for row in usable:
            if row != anchor and len(row[2]) == len(anchor[2]):
                score = sum(x * y for x, y in zip(anchor[2], row[2]))
                scores[row[1] == anchor[1]].add((-score, row[0]))
        for minus, positive in sorted(scores[True])[:positives]:
            inside = [
                (n, i) for n, i in sorted(scores[False]) if -percent * minus <= -100 * n <= -100 * minus
            ]
            for rank, (n, i) in enumerate(inside[:most], 1):
                out.append((anchor[0], positive, rank, i, -minus, -n))
    return sorted(out)


def mined(spark, rows):
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    found = negatives.mine(table, F.col("vec_id") % 10 == 0)
    return sorted(tuple(r) for r in found.collect())


@pytest.fixture(scope="module")
def rows():
    random = np.random.default_rng(3)
    centres = random.normal(size=(6, 8))
    out = []
    for i in range(400):
        v = centres[i % 6] + random.normal(size=8) * random.choice([0.05, 0.5])
        out.append((i, (v / random.uniform(0.5, 3)).tolist(), int(random.integers(0, 4))))
    return out


def test_equals_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "TILE", 16)
    want = expected(rows)
    assert len(want) > 200 and mined(spark, rows) == want


def test_many_small_cells_give_the_same(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "ROW_BYTES", 4000)
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 1000)
    assert mined(spark, rows) == expected(rows)


def test_nulls_ties_repeats_and_odd_vectors(spark, rows):
    odd = [
        (None, [1.0] * 8, 1),
        (500, None, 1),
        (510, [1.0] * 7 + [None], 1),
        (520, [1.0] * 7 + [float("nan")], 1),
        (530, [float("inf")] * 8, 1),
        (540, [1.0] * 8, None),
        (550, [0.0] * 8, 1),
        (560, [0.001] * 8, 2),
        (570, [], 1),
        (571, [], 2),
        (572, [], 1),
        (580, [1.0, 2.0], 1),
        (581, [1.0, 1.5], 2),
        (582, [1.0, 2.0], 1),
        # Another vector under an anchor's id, and an anchor that repeats.
        (0, rows[6][1], rows[0][2]),
        rows[10],
        rows[10],
    ]
    ties = [(600 + i, rows[0][1], rows[0][2]) for i in range(20)]
    ties += [(700 + i, rows[0][1], rows[0][2] + 1) for i in range(20)]
    every = rows + odd + ties + ties[:5]
    assert mined(spark, every) == expected(every)


def test_scores_beyond_doubles_are_exact(spark):
    big = [(i, [2.0**17 + i, 2.0**17 - i, 1.0 * i], i % 2) for i in range(40)]
    assert mined(spark, big) == expected(big)


def test_empty_table_and_no_anchor(spark, rows):
    assert mined(spark, []) == []
    assert mined(spark, [r for r in rows[1:30] if r[0] % 10]) == []


def test_bounds_hold_for_near_and_opposite_vectors():
    random = np.random.default_rng(1)
    v = random.normal(size=(60, 5)) * 100
    v = np.floor(np.concatenate([v, v * 1.0001, -v, v[:3] * 0]))
    norm = np.linalg.norm(v, axis=1)
    a = negatives.angles(v, norm, negatives.far_apart(v[:60])).astype(np.float32).astype(float)
    side = negatives.Side(np.arange(len(v)), np.zeros(len(v), int), v, norm, a)
    score = negatives.products(side, side)
    least, most = negatives.pair_bounds(side, side)
    assert (least <= score).all() and (score <= most).all()
    for tile in negatives.tiles(side):
        low, high = negatives.tile_bounds(side, tile)
        own = negatives.products(side, tile)
        assert (low[:, None] <= own).all() and (own <= high[:, None]).all()
    assert (most - least < 0.2 * norm[:, None] * norm[None, :]).mean() > 0.05
