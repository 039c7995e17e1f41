import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import xxhash

from obsflow.llm import simhash as sh
from obsflow.llm.components import connected_components, forest


def fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in text).split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, pairs):
    parent = {v: v for v in values}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        parent[find(a)] = find(b)
    least = defaultdict(lambda: None)
    for v in values:
        root = find(v)
        least[root] = v if least[root] is None else min(v, least[root])
    return {v: least[find(v)] for v in values}


TEXTS = [None, "", " \n", "One", "One two", "ONE  two\tthree", "one two three", " one two three four ",
         "é Ü ñ a b c d", "x\x1cy z w v", "a b a b a b a b " * 50, "a b a b a b a b " * 51, "ab" * 40_000]


def test_fingerprints():
    got = sh.simhash(pa.array(TEXTS))
    assert [int(x) & (2**64 - 1) for x in got] == [fingerprint(t) for t in TEXTS]
    assert sh.simhash(pa.array(TEXTS).slice(4, 5)).tolist() == got[4:9].tolist()
    assert sh.simhash(pa.array([], pa.string())).tolist() == []


def test_covering():
    """Every pair within the threshold meets at the home of either one."""
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(300)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 2))) for b in base]
    fps = np.array(base + near, np.uint64).view(np.int64)
    index, anchors, home = sh.anchors_of(fps)
    assert home.sum() == 600 and 50 < len(index) / 600 < 75
    at = defaultdict(set)
    homes = {}
    for i, a, h in zip(index.tolist(), anchors.tolist(), home.tolist()):
        at[i].add(a)
        if h:
            homes[i] = a
    for i in range(300):
        assert homes[i] in at[300 + i] and homes[300 + i] in at[i]


def test_near_duplicates(spark, docs, monkeypatch):
    monkeypatch.setattr(sh, "TILE", 3)
    rng = random.Random(2)
    words = [f"w{i}" for i in range(200)]
    texts = list(TEXTS)
    for _ in range(15):
        text = [rng.choice(words) for _ in range(rng.randint(40, 400))]
        for _ in range(rng.randint(1, 40)):
            texts.append(" ".join(text))
            text[rng.randrange(len(text))] = rng.choice(words)
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, None), (None, "One"), (None, "none like it at all")]
    fps = [fingerprint(r[1]) for r in rows]
    distinct = sorted(set(fps))
    pairs = [(a, b) for a in distinct for b in distinct if a < b and (a ^ b).bit_count() <= 2]
    assert len(pairs) > 100
    root = components(distinct, pairs)
    least = {}
    for (doc, _), fp in zip(rows, fps):
        if doc is not None:
            least[root[fp]] = min(doc, least.get(root[fp], doc))
    want = sorted((-1 if r[0] is None else r[0], fp, least.get(root[fp]) or -1) for r, fp in zip(rows, fps))
    df = sh.near_duplicates(docs([(*r, "s", 1) for r in rows], ", fp int"))
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.fp & (2**64 - 1), r.component_id or -1) for r in df.collect())
    assert got == want
    kept = sh.one_of_each(docs(rows))
    assert kept.columns == docs(rows).columns
    ids = sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect())
    assert ids == sorted({-1 if v is None else v for v in (least.get(root[fp]) for fp in fps)})


def test_links_over_batches():
    """A key that spans batches keeps its homes; links of every size of group are found."""
    rng = random.Random(3)
    fps = np.array([rng.getrandbits(3) | rng.getrandbits(3) << 50 for _ in range(500)], np.int64)
    fps = np.unique(fps)
    batch = lambda lo, hi: pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(hi - lo, np.int32)), pa.array(np.zeros(hi - lo, np.int32)),
         pa.array(fps[lo:hi]), pa.array(np.arange(lo, hi) < 10)], names=["anchor", "tile", "fp", "home"])
    found = list(sh._compare([batch(0, 5), batch(5, 40), batch(40, len(fps))]))
    got = [(a, b) for x in found for a, b in zip(x.column(0).to_pylist(), x.column(1).to_pylist())]
    pairs = [(int(a), int(b)) for a in fps[:10] for b in fps if a != b and int(a ^ b).bit_count() <= 2]
    nodes = [int(x) for x in fps]
    assert components(nodes, got) == components(nodes, pairs)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    a, b = forest(np.array([3, 5]), np.array([5, 9]))
    assert sorted(zip(a.tolist(), b.tolist())) == [(5, 3), (9, 3)]


def test_empty(docs):
    assert sh.near_duplicates(docs([])).count() == 0
    assert sh.one_of_each(docs([])).count() == 0
