import random
from collections import Counter

import pytest

import corpus_pipeline as pipeline
from obsflow.llm import mixing, quality, sentencepiece as sp
from test_classifiers import corpus
from test_simhash import components, fingerprint
from test_substring import brute


@pytest.fixture(scope="module")
def raw():
    rows, labels = corpus(250)
    good = [t for (i, t), l in zip(rows, labels) if l[1] == 1]
    passage = " ".join(f"pass{i} age{i} of{i} words{i}." for i in range(16))
    rows = [(i, t, f"src{i % 3}" if i % 7 else None) for i, t in rows]
    rows += [(1000 + i, good[i], "src0") for i in range(20)] + [(2000 + i, f"{good[40 + i]}\n{passage}", "src1") for i in range(10)]
    return rows + [(3000, None, "src0"), (3001, "", "src1"), rows[0]], labels


def test_stages_against_brute_force(spark, docs, raw, tmp_path):
    rows, labels = raw
    names = [name for name, _ in pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "mix_sources", "sentencepiece"]
    df = docs(rows)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf = str(tmp_path)

    held = {}
    for name, stage in pipeline.STAGES:
        stage(spark, df, sf).write.parquet(f"{tmp_path}/{name}")
        before, df = df.collect(), spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = before, df.collect()
        if name != "sentencepiece":
            assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]

    before, after = held["quality_classifier"]
    model = quality.train(docs(rows), spark.read.parquet(f"{sf}/labels.parquet"), quality.remainder(3) != 1)
    scores = {(r.doc_id, r.text): r.score for r in quality.score(docs(rows), model).collect()}
    assert Counter((r.doc_id, r.text) for r in after) == Counter((r.doc_id, r.text) for r in before if scores[r.doc_id, r.text] >= 0.5)
    truth = {l[0]: l[1] for l in labels}
    wrong = [i for (i, _), s in scores.items() if truth.get(i) is not None and truth[i] != (s >= 0.5)]
    assert len(wrong) < 0.03 * len(truth)

    before, after = held["simhash_near_dedup"]
    fps = {fingerprint(r.text) for r in before}
    root = components(sorted(fps), [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 2])
    least = {}
    for r in before:
        least[root[fingerprint(r.text)]] = min(r.doc_id, least.get(root[fingerprint(r.text)], r.doc_id))
    assert sorted(r.doc_id for r in after) == sorted(least.values())

    before, after = held["substring_dedup"]
    want = brute([(r.doc_id, r.text) for r in before])
    assert sorted((r.doc_id, r.text) for r in after) == sorted((d, t) for d, t, _, _ in want)
    assert sum(n > 0 for *_, n in want) >= 5
    assert all(r.n_chars == len(r.text or "") for r in after)

    before, after = held["mix_sources"]
    plan = {r.doc_id: r.times for r in mixing.mix(docs([(r.doc_id, r.text, r.source) for r in before])).collect()}
    assert Counter(r.doc_id for r in after) == Counter({d: n for d, n in plan.items() if n})

    before, after = held["sentencepiece"]
    model = sp.pieces()
    assert len(before) == len(after)
    assert all(r.exact and model.decode(r.token_ids) == (r.text or "") and r.n_tokens == len(r.token_ids) for r in after)

    final = pipeline.run(spark, sf)
    assert Counter((r.doc_id, tuple(r.token_ids)) for r in final.collect()) == Counter((r.doc_id, tuple(r.token_ids)) for r in after)


def test_empty_and_clashing(spark, docs, tmp_path):
    names = ("score", "_doc2", "fp", "row", "number", "places", "row_hash", "n_removed", "again", "exact2")
    df = docs([(1, "a b c", "s", *range(10)), (2, None, "s", *range(10))], "".join(f", {n} int" for n in names))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (df, df.limit(0)):
        want = frame.count()
        for name, stage in pipeline.STAGES:
            out = stage(spark, frame, str(tmp_path))
            if name != "sentencepiece":
                assert out.columns == frame.columns
            assert out.count() <= 2 and (want or out.count() == 0)


def test_near_copies_go(spark, docs):
    """Two bits of the fingerprints decide, over chains too; other texts stay."""
    rng = random.Random(12)
    words = [f"word{i}" for i in range(4000)]
    rows = []
    for _ in range(12):
        text = [rng.choice(words) for _ in range(400)]
        for _ in range(6):
            rows.append((len(rows), " ".join(text)))
            text[rng.randrange(400)] = rng.choice(words)
    fps = [fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    root = components(list(range(len(fps))), pairs)
    least = {}
    for i in range(len(fps)):
        least[root[i]] = min(i, least.get(root[i], i))
    kept = sorted(r.doc_id for r in pipeline.drop_near_duplicates(spark, docs(rows), "").collect())
    assert kept == sorted(least.values()) and 12 <= len(kept) < len(rows)
    assert any(fps[i] != fps[j] for i, j in pairs)
