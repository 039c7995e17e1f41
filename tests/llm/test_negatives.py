import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from obsflow.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<float>, label int, score int, number int"


def brute(rows, every):
    good = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good.append((i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    anchors = {}
    for i, label, v in good:
        if i % every == 0:
            anchors[i] = min((label, v), anchors.get(i, (label, v)))
    out = []
    for a, (label, w) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, k) for i, k, v in good if i != a and len(v) == len(w))
        for p, positive, _ in [x for x in scored if x[2] == label][:5]:
            hard = [(i, -s) for s, i, k in scored if k != label and 80 * -p <= 100 * -s <= 100 * -p][:5]
            out += [(a, positive, r + 1, i, -p, s) for r, (i, s) in enumerate(hard)]
    return sorted(out)


def check(spark, rows, every=5):
    df = spark.createDataFrame([(i, v, k, 1, 2) for i, v, k in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = ng.mined(ng.labelled(df, ng._shifted()), F.col("vec_id") % every == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    got = sorted(map(tuple, got.collect()))
    assert got == brute(rows, every)
    return got


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ng, "BLOCK", 30)
    monkeypatch.setattr(ng, "ANCHORS", 7)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist(), int(rng.integers(3))) for i in range(200)]
    centres = rng.normal(size=(6, 4)) * 3
    rows += [(200 + i, (centres[i % 6] + rng.normal(size=4) * 0.1).tolist(), i % 4) for i in range(200)]
    rows += [(400 + i, [0.5, 0.25, -0.5, 0.0], i % 2) for i in range(60)]
    rows += [(500, [0.0] * 4, 1), (501, None, 1), (502, [None] * 4, 1), (503, [float("nan")] * 4, 1), (504, [1.0] * 4, None),
             (505, [float("inf"), 0.0, 0.0, 0.0], 1), (None, [1.0] * 4, 1), (5, [9.0, 0.0, 0.0, 0.0], 0), (400, [0.5, 0.25, -0.5, 0.0], 1),
             (600, [1.0, 2.0], 1), (601, [2.0, 1.0], 1), (602, [2.0, 1.5], 2), (603, [1.0, 1.0], 2), (605, [], 1), (700, [1e9, 0.0, 0.0, 0.0], 1)]
    assert len(check(spark, rows)) > 300


def test_few_rows(spark):
    assert check(spark, []) == []
    assert check(spark, [(0, [1.0], 1)]) == []
    assert check(spark, [(5, [1.0], 1), (1, [1.0], 1), (2, [0.9], 2)]) == [(5, 1, 1, 2, 65536, 256 * 230)]
    assert check(spark, [(5, [1.0], 1), (1, [-1.0], 1), (2, [-0.9], 2)]) == []


@pytest.mark.parametrize("size", [2, 16])
def test_bounds_hold(size):
    """No score lies outside the bounds, by rows and by blocks."""
    rng = np.random.default_rng(size)
    rows = np.vstack([rng.integers(-300, 300, (300, size)), np.zeros((1, size), int), np.eye(size, dtype=int)[:1] * 10**6])
    rows = np.vstack([rows, rows[:5] * 7, -rows[:5]])
    norm, angles = ng.angles_to(rows, ng.references(rows.tolist())[size])
    angles = angles.astype(np.float32).astype(float)
    real = rows @ rows.T
    low, high = ng.bounds(angles[:, None], angles[:, None], angles[None], angles[None], norm[:, None] * norm, norm[:, None] * norm)
    assert (low <= real).all() and (real <= high).all()
    for part in np.array_split(np.arange(len(rows)), 9):
        a, n = angles[part], norm[part]
        low, high = ng.bounds(angles, angles, a.min(axis=0), a.max(axis=0), norm * n.min(), norm * n.max())
        assert (low <= real[:, part].min(axis=1)).all() and (real[:, part].max(axis=1) <= high).all()


def test_windows_leave_rows_out():
    """In clusters most rows of a block are never scored."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8)) * 300
    rows = (centres[np.arange(2000) % 20] + rng.normal(size=(2000, 8)) * 10).astype(int)
    norm, angles = ng.angles_to(rows, ng.references(rows.tolist())[8])
    block = ng.Block(np.arange(2000), np.arange(2000) // 20 % 4, rows, norm, angles.astype(np.float32))
    scored = []
    real, ng.scores_of = ng.scores_of, lambda v, q: (scored.append(len(v)), real(v, q))[1]
    try:
        ids, scores = block.positives(0, 0, rows[0], norm[0], angles[0], 5)
        found = list(block.negatives(0, 0, rows[0], norm[0], angles[0], scores, 5, 80))
    finally:
        ng.scores_of = real
    assert len(ids) == 5 and all(len(x[0]) == 5 for x in found)
    assert sum(scored) < 600
