import random
import zlib
from hashlib import sha256

import pytest

from obsflow.llm import merkle


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    fields = (row[0], row[3], row[2], row[4], row[1])
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(nodes):
    """All levels from the leaves up to a single node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def sides(levels, i):
    out = []
    for nodes in levels[:-1]:
        start = i // 8 * 8
        out.append(("".join(nodes[start:i]), "".join(nodes[i + 1:start + 8])))
        i //= 8
    return out


def small(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    """rows: (doc_id, text, lang, source, n_chars)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    of = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is None, r[0] or 0, leaf(r))) for x in langs}
    trees = {x: tree([leaf(r) for r in of[x]]) for x in langs}
    top = tree([trees[x][-1][0] for x in langs])
    out = []
    for place, x in enumerate(langs):
        for i, r in enumerate(of[x]):
            path = sides(trees[x], i) + sides(top, place)
            claim = leaf((r[0], small(r[1]), *r[2:])) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else leaf(r)
            for left, right in path:
                claim = h(left, claim, right)
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[x][-1][0], root, h(*(a + b for a, b in path)), claim, claim == root))
    return sorted(out, key=str)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree int, pos string, digest string"


def check(spark, rows, path):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    got = merkle.verified(df, str(path), merkle.lowered_third())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, got.collect()), key=str)
    assert got == brute(rows)
    return got


def corpus():
    rng = random.Random(3)
    row = lambda i, lang: (i, rng.choice(["", "low", "Üpper A", "AZ" * rng.randrange(40)]), lang, rng.choice(["s", None]), rng.randrange(9))
    rows = [row(i, "en") for i in range(1200)] + [row(5000 + i, "de") for i in range(513)] + [row(9000 + i, None) for i in range(64)]
    rows += [(7000, None, "fr", None, None), (None, "A", "en", "s", 1), (None, None, None, None, None), (3, "Z" * 50_000, "en", "s", 1)]
    rows += [rows[7]] * 20 + [(8000 + i, "X", f"l{i:02d}é", "s", 1) for i in range(70)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("keep", [3, 1, 2])
def test_against_brute_force(spark, tmp_path, monkeypatch, keep):
    monkeypatch.setattr(merkle, "KEEP", keep)
    monkeypatch.setattr(merkle, "SPAN", 8**keep)
    got = check(spark, corpus(), tmp_path / "m")
    assert {r[6] for r in got} == {True, False}


def test_few_rows(spark, tmp_path):
    assert check(spark, [], tmp_path / "a") == []
    lone = check(spark, [(1, "A b", "en", "s", 3)], tmp_path / "b")[0]
    assert lone[1] == lone[2] == lone[3] and lone[4] == h("")
    check(spark, [(1, "A", "en", "s", 1), (2, "b", "de", "s", 1)], tmp_path / "c")
    check(spark, [(i, "A", "en", "s", 1) for i in range(9)], tmp_path / "d")


def test_paths_of_a_stored_manifest(spark, docs, tmp_path):
    """Only every third level is stored; read again, it gives the path of every leaf."""
    rows = [(i, f"text {i}") for i in range(700)]
    stored = merkle.manifest(docs(rows), f"{tmp_path}/m")
    assert [level.count() for level in stored] == [700, 2, 1]
    again = merkle.read(spark, f"{tmp_path}/m", stored[0].schema)
    got = merkle.proofs(again, f"{tmp_path}/p").collect()
    assert len(got) == 700 and len({r.root for r in got}) == 1
    for r in got:
        assert merkle.fold(r.digest, [(s.left, s.right) for s in r.path]) == r.root
        assert len(r.path) == 4
    assert merkle.fold("0" * 64, [(s.left, s.right) for s in got[5].path]) != got[5].root
