import hashlib
import random
import re

import pyarrow as pa

from obsflow.llm import minhash as mh
from test_simhash import components, fingerprint as simhash


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def corpus():
    rng = random.Random(9)
    words = [f"w{i}é" for i in range(300)]
    rows = [(500, None), (501, ""), (502, "two words"), (503, " "), (504, "z" * 40_000)]
    for g in range(12):
        text = [rng.choice(words) for _ in range(rng.randint(5, 300))]
        for _ in range(rng.randint(1, 6)):
            rows.append((len(rows), " ".join(text)))
            text[rng.randrange(len(text))] = rng.choice(words)
    return rows


def test_edited(docs):
    rows = corpus()
    order = sorted(rows)
    repeated = rows + [rows[7], rows[7]]
    got = mh.edited(docs([(*r, "s", 1) for r in repeated], ", head int")).collect()
    assert len(got) == len(repeated)
    by_id = {r.doc_id: r for r in got}
    for k, (doc, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        n = len(text)
        want = text[: n - n // 4] + after[: n // 4]
        r = by_id[doc]
        assert (r.n_chars, r.edited_sha256) == (n, hashlib.sha256(want.encode()).hexdigest())
        assert abs(r.near_edited - jaccard(text, want)) < 0.17
        assert abs(r.near_next - jaccard(text, after)) < 0.17
    by_text = {}
    for r in got:
        assert by_text.setdefault(dict(rows)[r.doc_id] or "", r.fingerprint) == r.fingerprint
    assert by_id[500].fingerprint == by_id[501].fingerprint == by_id[503].fingerprint
    lone = mh.edited(docs([(1, "abcdefgh")])).first()
    assert lone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_batches():
    texts = pa.array([r[1] for r in corpus()])
    whole = mh.signatures(texts)
    for k in (0, 5, 11):
        assert (mh.signatures(texts.slice(k, 1))[0] == whole[k]).all()


def test_few_words(docs):
    """Texts of none to six words, each alone in its partition and after a long text."""
    short = [" ".join("abcdef"[:n]) for n in range(7)]
    lone = mh.edited(docs(list(enumerate(short))).repartition(7, "doc_id")).collect()
    assert {r.doc_id: r.n_chars for r in lone} == {i: len(t) for i, t in enumerate(short)}
    for text in short:
        texts = pa.array(["w " * 600_000, text])
        assert (mh.signatures(texts)[1] == mh.signatures(texts.slice(1, 1))[0]).all()
        assert mh.edited(docs([(1, text)])).first().near_next == 1


def test_near_pairs(docs):
    rows = corpus() + [(900, corpus()[9][1]), (None, None)]
    members, pairs = mh.near_pairs(docs(rows))
    text_of = {r[0]: r[1] for r in rows}
    name = {}
    for r in members.collect():
        name.setdefault(r["class"], r.doc_id)
    got = {tuple(sorted((name[r.a], name[r.b]))) for r in pairs.collect()}
    ids = [i for i in name.values()]
    want = {tuple(sorted((a, b))) for a in ids for b in ids if a < b and jaccard(text_of[a], text_of[b]) >= 0.8}
    assert got == want and len(want) > 10
    assert mh.near_duplicates(docs(rows)).count() == len(rows)


def test_empty(docs):
    assert mh.edited(docs([])).count() == 0
    assert mh.near_duplicates(docs([])).count() == 0


def test_one_of_each(docs, monkeypatch):
    """Near copies beyond the reach of op5's fingerprints go, texts below the similarity stay."""
    monkeypatch.setattr(mh, "TILE", 3)
    rng = random.Random(4)
    words = [f"w{i}é" for i in range(3000)]
    rows = [(500, None), (501, ""), (502, "Two words"), (503, "two WORDS"), (None, "none like it at all"), (None, "two words")]
    for g in range(8):
        text = [rng.choice(words) for _ in range(200)]
        for n in (0, 3, 3, 4, 6, 20):  # edits
            copy = list(text)
            for k in rng.sample(range(200), n):
                copy[k] = rng.choice(words)
            rows.append((len(rows), " ".join(copy)))
    low = {i: (t or "").lower() for i, (_, t) in enumerate(rows)}
    pairs = [(i, j) for i in low for j in low if i < j and jaccard(low[i], low[j]) >= 0.8]
    far = [p for p in pairs if (simhash(low[p[0]]) ^ simhash(low[p[1]])).bit_count() > 2]
    root = components(list(low), pairs)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root[i]] = min((doc is None, doc or 0), least.get(root[i], (True, 0)))
    kept = mh.one_of_each(docs(rows + rows[:9]))
    assert kept.columns == docs(rows).columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(least.values())
    assert len(far) > 20 and len(least) < len(rows) - 20


def test_equal_signatures_are_not_one_class(docs):
    """Texts of different shingle sets are verified each, also where all minima agree."""
    text = [f"w{i}" for i in range(3000)]
    rows = [(0, " ".join(text))] + [(k, " ".join(text[:-k])) for k in range(1, 40)]
    signed = {r.doc_id: r.signature for r in mh.fingerprints(docs(rows)).collect()}
    assert len(set(signed.values())) < len(rows)
    assert mh.near_duplicates(docs(rows)).select("class").distinct().count() == len(rows)
