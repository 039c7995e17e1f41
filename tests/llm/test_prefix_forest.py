import math

import numpy as np
from pyspark.sql import functions as F

from obsflow.llm import prefix_forest as pf

SCHEMA = "vec_id long, embedding array<float>, label int, score int, block int"


def run(spark, rows, every=5, k=4, **meet):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = pf.nearest(pf.taking_part(df), F.col("vec_id") % every == 0, k, **meet).collect()
    return rows, sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got)


def brute(rows, every, k):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    queries = {}
    for i, v in good:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, w in queries.items():
        scored = sorted((-(np.array(v) * np.array(w)).sum(), i) for i, v in good if i != q and len(v) == len(w))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def odd(rng):
    rows = [(i, rng.normal(size=4).tolist()) for i in range(150)]
    rows += [(i, [0.5, 0.25, -0.5, 0.0]) for i in range(150, 190)] + [(190, [0.0] * 4), (191, None), (192, [None] * 4)]
    rows += [(193, [float("nan")] * 4), (194, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (5, [9.0, 0.0, 0.0, 0.0]),
             (150, [0.5, 0.25, -0.5, 0.0]), (200, [1.0, 2.0]), (201, [2.0, 1.0]), (205, []), (300, [1e30, 0.0, 0.0, 0.0]), (305, [7.0])]
    return rows


def test_all_rows_met(spark, monkeypatch):
    """Where as many rows are asked for as there are, the result is exact."""
    monkeypatch.setattr(pf, "BLOCK", 40)
    monkeypatch.setattr(pf, "QUERIES", 7)
    rows, got = run(spark, odd(np.random.default_rng(6)), least=1e9)
    want = brute(rows, 5, 4)
    assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want], rtol=1e-14)
    assert len(got) > 100


def test_few_rows(spark):
    assert run(spark, [])[1] == []
    assert run(spark, [(0, [1.0])])[1] == []
    assert run(spark, [(0, [1.0]), (1, [0.5])])[1] == [(0, 1, 1, 0.5)]


def test_longest_prefixes_first():
    """With few rows asked for, what is met shares the longest prefixes over all trees."""
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(3000, 8))
    forest = pf.Forest(np.arange(3000), rows)
    queries = rows[:20] + rng.normal(size=(20, 8)) * 0.05
    begins, ends = forest.met(queries, 300, 0.0)
    scaled = queries / np.sqrt((queries**2).sum(axis=1))[:, None]
    keys = pf.strings(np.column_stack([scaled, np.zeros(20)]))
    for i in range(20):
        shared = 64 - np.ceil(np.log2((forest.keys ^ keys[:, i, None]).astype(float) + 1)).astype(int)
        level = next(x for x in range(64, -1, -1) if (shared >= x).sum() >= 300)
        total = 0
        for t in range(pf.TREES):
            wide = (shared >= level + 1).sum() + total < 300
            take = shared[t] >= (level if wide else level + 1)
            total += take.sum() - (shared[t] >= level + 1).sum()
            assert np.flatnonzero(take).tolist() == list(range(begins[t, i], ends[t, i]))
        assert (ends[:, i] - begins[:, i]).sum() >= 300


def recall(spark, vectors, every, k=20, **meet):
    rows, got = run(spark, list(enumerate(vectors.tolist())), every, k, **meet)
    want = {r[:1] + r[2:3] for r in brute(rows, every, k)}
    return len(want & {r[:1] + r[2:3] for r in got}) / len(want)


def test_recall(spark):
    """Without any structure, in clusters, and with lengths that differ."""
    rng = np.random.default_rng(7)
    plain = rng.normal(size=(6000, 64))
    plain /= np.sqrt((plain**2).sum(axis=1))[:, None]
    assert recall(spark, plain, 100) >= 0.9
    assert recall(spark, plain * rng.uniform(0.5, 2, size=(6000, 1)), 100) >= 0.9
    groups = rng.normal(size=(200, 64))[rng.integers(0, 200, 6000)] + rng.normal(size=(6000, 64)) * 0.1
    assert recall(spark, groups, 100, least=400, share=0.0) >= 0.9
