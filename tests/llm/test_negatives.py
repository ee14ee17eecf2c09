"""Hard negatives against all pairs."""

import math
import random

import numpy as np
import pytest

from costalloc.llm import negatives

SCHEMA = "vec_id bigint, label int, embedding array<float>, score string, row string"


def plain(rows, every=100):
    """rows: (vec_id, label, vector), each once."""
    good = [(i, lab, [min(negatives.LARGEST, max(-negatives.LARGEST, math.floor(256 * float(np.float32(x))))) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for n, (i, lab, v) in enumerate(good):
        if i % every:
            continue
        others = sorted((-score(v, w), j, m != lab) for k, (j, m, w) in enumerate(good) if k != n)
        for p, pid in [(-s, j) for s, j, far in others if not far][:5]:
            near = [(-s, j) for s, j, far in others if far and 80 * p <= 100 * -s <= 100 * p][:5]
            out += [(i, pid, r, j, p, s) for r, (s, j) in enumerate(near, 1)]
    return sorted(out)


def got(frame, **how):
    return sorted(map(tuple, negatives.hard_negatives(frame, **how).collect()))


def sample(seed, n=700, places=12, clusters=30):
    """Clusters with spread, of different lengths of vectors' norms, copies of vectors, and labels that cut across."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, places))
    rows = []
    for i in range(n):
        v = centres[rng.integers(clusters)] * rng.choice([0.1, 1.0, 3.0]) + rng.normal(size=places) * rng.choice([0.0, 0.05, 0.6])
        rows.append((i, int(rng.integers(4)) if i % 3 else 0, [float(np.float32(x)) for x in v]))
    return rows


@pytest.mark.parametrize("block_bytes", [1 << 20, 4000])
def test_against_all_pairs(spark, block_bytes):
    rows = sample(3)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    want = plain(rows, every=10)
    assert got(frame, every=10, block_bytes=block_bytes) == want and len(want) > 200


def test_many_equal_scores(spark):
    """Ties are settled by the id, also between tasks."""
    rows = [(i, i % 2, [1.0, 0.0]) for i in range(400)] + [(i, 2, [0.9, 0.1]) for i in range(400, 500)]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(6)
    assert got(frame) == plain(rows)


def test_odd_rows(spark):
    rows = [
        (None, 1, [1.0]), (100, 1, [1.0, 1.0]), (100, 1, [1.0, 1.0]), (100, 2, [0.5, 1.0]), (1, None, [1.0, 1.0]), (2, 1, None),
        (3, 1, [None, 1.0]), (4, 1, [float("nan"), 1.0]), (5, 1, [float("inf"), 1.0]), (6, 1, [0.5, 0.5]), (6, 1, [0.5, 0.5]),
        (7, 2, [0.5]), (8, 2, [0.9, 0.1, 7.0]), (9, 2, []), (10, 2, [0.0, 0.0]), (11, 1, [1e30, -1e30]), (12, 3, [-1.0, -1.0]),
        (200, 5, [-1.0, 0.0]), (13, 5, [1.0, 0.0]), (14, 6, [0.9, 0.0]), (300, 9, [1.0] * 5000), (301, 9, [1.0] * 5000), (302, 8, [0.9] * 5000),
    ]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    once = [r for k, r in enumerate(rows) if r not in rows[:k]]
    want = plain(once)
    assert got(frame) == want and want
    assert got(frame.limit(0)) == [] and got(frame.where("vec_id > 300")) == []


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(1)

    def stretch(points):
        norm = np.linalg.norm(points, axis=1)
        s = negatives.Stretch.__new__(negatives.Stretch)
        s.vec, s.norm = points, norm
        s.cos = np.clip(points @ reference.T / np.maximum(norm, 1e-300)[:, None], -1, 1)
        s.sin = np.sqrt(np.maximum(0, 1 - s.cos**2))
        s.row, s.largest = np.arange(len(points)), float(np.abs(points).max())
        return s

    reference = rng.normal(size=(4, 6))
    reference /= np.linalg.norm(reference, axis=1)[:, None]
    points = np.floor(256 * rng.normal(size=(300, 6)))
    points[:4] = np.floor(25600 * reference)  # angles near 0, where cosines say little
    points[4:8] = -points[:4]
    a, all_rows = stretch(points), np.arange(300)
    low, high = negatives.bounds(a, all_rows, a)
    score = negatives.products(a, all_rows, a)
    assert (low <= score).all() and (score <= high).all()
    assert (score.max(axis=1) <= negatives.far_bound(a, all_rows, a)).all()
    near = stretch(points[4:5] + rng.integers(-3, 3, size=(50, 6)))
    assert (negatives.far_bound(a, all_rows, near) < 0).any()  # a whole stretch on the other side is skipped


def test_row_order_does_not_matter(spark):
    rows = sample(5, n=300)
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    random.Random(2).shuffle(rows)
    again = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    assert got(frame, every=20, n_references=2) == got(again, every=20)
