import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from obsflow.llm import quality, toxicity

ODD = [None, "", " \n\t", "!", "a", "x" * 60_000, "é é\n|\n", "one two. one two. one two."]


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    ones = y == 1
    return (order[ones].sum() - ones.sum() * (ones.sum() - 1) / 2) / (ones.sum() * (~ones).sum())


def corpus(n=600):
    rng = random.Random(8)
    words = [f"w{rng.randrange(9)}{c}{d}" for c in "abcdefgh" for d in "rstuvw"]
    good = lambda: ". ".join(" ".join(rng.choice(words) for _ in range(9)) for _ in range(rng.randint(2, 9))) + "."
    junk = [lambda: " ".join(rng.choice(words).upper() + "!!" for _ in range(40)), lambda: "\n".join([good()] * 6),
            lambda: " | ".join(rng.choice(words) for _ in range(50))]
    bad = ["idiot", "scum", "loweia", "loweib", "loweic"]
    rows, labels = [], []
    for i in range(n):
        text, quality_, toxic = good(), int(rng.random() > 0.25), int(rng.random() < 0.2)
        if not quality_:
            text = rng.choice(junk)()
        if toxic:
            text = f"{text} {rng.choice(bad)} {rng.choice(bad)}."
        rows.append((i, text))
        labels.append((i, quality_, toxic))
    return rows, labels


def test_features_by_hand():
    x = dict(zip(quality.NAMES, quality.features(pa.array(["AB cd. cd. 12!\nx"]))[0]))
    assert np.isclose(x["words"], np.log1p(5)) and np.isclose(x["word_length"], 13 / 5 - 0.2)
    assert np.isclose(x["upper"], 2 / 16) and np.isclose(x["digits"], 2 / 16) and np.isclose(x["bangs"], 1 / 16)
    assert np.isclose(x["distinct_words"], 4 / 5) and np.isclose(x["same_as_before"], 1 / 5)
    assert np.isclose(x["sentence_length"], 5 / 4) and np.isclose(x["line_length"], 5 / 2)
    assert np.isclose(x["upper_words"], 1 / 5) and np.isclose(x["marked_words"], 1 / 5)
    odd = quality.features(pa.array(ODD, pa.string()))
    assert np.isfinite(odd).all() and (odd[0] == odd[1]).all()
    again = quality.features(pa.array(["one two. one two. one two. other."]))[0][quality.NAMES.index("again")]
    assert np.isclose(again, 4 / 7)


def test_additive_model():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(4000) < 0.02)).astype(float)
    model = quality.fit(x[:3000], y[:3000])
    assert {(i, j) for i, j, _, _ in model.pairs} >= {(0, 1)}
    assert auc(model.score(x[3000:]), y[3000:]) > 0.9
    k = x[:5]
    by_hand = [model.intercept + sum(t[np.searchsorted(e, r[n], "right")] for n, (e, t) in enumerate(zip(model.edges, model.tables)))
               + sum(v[np.searchsorted(a, r[i], "right"), np.searchsorted(b, r[j], "right")] for i, j, (a, b), v in model.pairs) for r in k]
    assert np.allclose(model.margin(k), by_hand)
    assert np.isclose(quality.fit(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))), 0.5).all()
    assert (quality.fit(np.zeros((9, 3)), np.ones(9)).score(np.zeros((2, 3))) > 0.9).all()


def frames(spark, docs):
    rows, labels = corpus()
    rows = rows + [(10_000 + i, t) for i, t in enumerate(ODD)] + [(None, "x y"), rows[0]]
    labels = labels + [(3, None, None), (None, 1, 1), (99_999, 0, 1)]
    return docs(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), rows, labels


def held_out(df, labels, name, modulus, left):
    scores = {r.doc_id: r.score for r in df.collect()}
    assert all(0 <= s <= 1 for s in scores.values())
    index = {"quality": 1, "toxic": 2}[name]
    held = [r for r in labels if r[0] in scores and r[0] is not None and r[index] is not None
            and zlib.crc32(str(r[0]).encode()) % modulus == left]
    return np.array([scores[r[0]] for r in held]), np.array([r[index] for r in held])


def test_quality(spark, docs):
    df, labels, rows, known = frames(spark, docs)
    scored = quality.score(df, quality.train(df, labels, quality.remainder(3) != 1))
    assert scored.columns == df.columns + ["score"] and scored.count() == len(rows)
    s, y = held_out(scored, known, "quality", 3, 1)
    assert auc(s, y) > 0.97 and ((s >= 0.5) == y).mean() > 0.95
    empty = df.limit(0)
    model = quality.train(empty, labels, quality.remainder(3) != 1)
    assert quality.score(empty, model).count() == 0
    assert set(r.score for r in quality.score(df, model).collect()) == {0.5}


def test_toxicity(spark, docs):
    df, labels, rows, known = frames(spark, docs)
    scored = toxicity.score(df, toxicity.train(df, labels, quality.remainder(5) != 0))
    assert scored.count() == len(rows)
    s, y = held_out(scored, known, "toxic", 5, 0)
    assert auc(s, y) > 0.95 and ((s >= 0.5) == y).mean() > 0.95
    none = toxicity.train(df, labels.filter("toxic = 0"), F.lit(True))
    assert set(r.score for r in toxicity.score(df, none).collect()) == {0.0}
    assert toxicity.score(df.limit(0), toxicity.train(df.limit(0), labels, F.lit(True))).count() == 0


def test_non_negative_risk():
    """Where unlabelled texts hold toxic ones too, these are scored as toxic."""
    rng = np.random.default_rng(1)
    lists = [np.array([0]) for _ in range(50)] + [np.array([0]) if rng.random() < 0.3 else np.array([1]) for _ in range(500)]
    weights, bias = toxicity.fit(lists, np.arange(550) < 50, 2, 0.3)
    assert weights[0] + bias > 0 > weights[1] + bias


def test_scores_do_not_depend_on_batches():
    texts = pa.array([t for _, t in corpus(40)[0]] + ODD)
    whole = quality.features(texts)
    model = toxicity.Classifier(np.sort(toxicity.word_features(texts)[0][:50]), np.ones(50), -1.0)
    for k in (0, 7, 41):
        assert np.allclose(quality.features(texts.slice(k, 1))[0], whole[k])
        assert np.isclose(model.score(texts.slice(k, 1))[0], model.score(texts)[k])
