import math
import random

from pyspark.sql import functions as F

from obsflow.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, score int, rank int"


def brute(rows, every, k):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = []
    for q, w in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, v in good if i != q and len(v) == len(w))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def check(spark, rows, every=5, k=4):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(map(tuple, topk.top_k(topk.quantised(df), F.col("vec_id") % every == 0, k).collect()))
    assert got == brute(rows, every, k)
    return got


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 40)
    monkeypatch.setattr(topk, "QUERIES", 7)
    monkeypatch.setattr(topk, "FIRST_DEPTH", 2)
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(4)]) for i in range(150)]
    rows += [(i, [0.5, 0.25, -0.5, 0.0]) for i in range(150, 190)] + [(190, [0.0] * 4), (191, None), (192, [None] * 4)]
    rows += [(193, [float("nan")] * 4), (194, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4), (5, [9.0, 0.0, 0.0, 0.0]),
             (150, [0.5, 0.25, -0.5, 0.0]), (200, [1.0, 2.0]), (201, [2.0, 1.0]), (205, []), (300, [1e12, 0.0, 0.0, 0.0])]
    assert len(check(spark, rows)) > 100


def test_few_rows(spark):
    assert check(spark, []) == []
    assert check(spark, [(0, [1.0])]) == []
    assert check(spark, [(0, [1.0]), (1, [0.5])]) == [(0, 1, 1, 256 * 128)]


def test_stops_early():
    import numpy as np
    ids = np.arange(10_000)
    rows = np.zeros((10_000, 2), np.int64)
    rows[:, 0] = ids
    block = topk.Block(ids, rows)
    calls = []
    score = block.scores
    block.scores = lambda at, q: (calls.append(len(at)), score(at, q))[1]
    best, scores = block.best(-1, np.array([1, 0]), 3)
    assert best.tolist() == [9999, 9998, 9997] and sum(calls) < 100
