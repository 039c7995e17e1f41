import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from obsflow.llm import tokens as tk

TEXTS = ["", " ", "Hello, World's 12 km!", "naïve ÉTÉ é ́x àb", "日本語 текст x\x85y\xa0z", "a\x1cb\x00c",
         "<|endoftext|> x<|startoftext|>", "it's I'll ­soft​zero", "ΣΑΣ ΟΔΟΣ. İI", "x" * 3000, "...!!! ''' s'd", "👩‍👩‍👧 힣 ᄀ ᅡ"]


def ids_of(text):
    tokenizer = Tokenizer.from_file(tk.MODEL)
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def test_tokeniser_equals_the_library():
    rng = random.Random(3)
    alphabet = "aB s't.,!\t\né́ÅΣσς1२ 日ß'<|>x"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 80))) for _ in range(300)]
    ids, offsets = tk.Tokeniser()(pa.array(texts))
    for k, text in enumerate(texts):
        assert ids[offsets[k]:offsets[k + 1]].tolist() == ids_of(text), repr(text)


def test_words_with_marks_are_learnt_once(monkeypatch):
    tokenise, whole = tk.Tokeniser(), []

    class Library:
        def encode_batch_fast(self, chunks, **options):
            whole.extend(chunks)
            return model.encode_batch_fast(chunks, **options)

    model, tokenise.model = tokenise.model, Library()
    texts = ["That&&& that### that.*** été--", "That### that... That", "don't. x" + "!" * 9, "w" * 70 + "? " + "W" * 80, None]
    ids, offsets = tokenise(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [ids_of(t) for t in texts]
    assert sorted(whole) == sorted(["", "&&&", "###", ".***", "--", "...", "don't.", "x" + "!" * 9, "?"])
    assert not [c for c in tokenise.known if len(c) > tk.LONG]
    kept = len(tokenise.sizes)
    assert tokenise(pa.array(texts))[0].tolist() == ids.tolist() and len(tokenise.sizes) == kept
    monkeypatch.setattr(tk, "CACHE", 3)
    assert tokenise(pa.array(texts))[0].tolist() == ids.tolist()


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 1000, 40_000, 150_001])
def test_coder_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 49408, n), rng.zipf(1.3, n) % 1000, np.full(n, 7), np.arange(n) % 17,
                rng.integers(0, 2, n) * 49407):
        coded = tk.compress(ids)
        assert np.array_equal(tk.decompress(coded), ids)
    if n > 10_000:
        assert len(tk.compress(np.arange(n) % 17)) < n / 2


def test_files(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(tk, "BLOCK", 200)
    rng = random.Random(1)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, " ".join(rng.choice(["the", "Cat", "sat"]) for _ in range(rng.randint(0, 60)))) for i in range(60)]
    rows += [(7, None), (3, TEXTS[3]), (None, "last one"), (999, "long word " * 20_000)]
    rng.shuffle(rows)
    path = f"{tmp_path}/files"
    tk.write(docs([(*r, "s", 1) for r in rows], ", part int"), path)
    got = sorted(tk.digest(spark, path).collect(), key=lambda r: r.start)
    want = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    assert [r.doc_id for r in got] == [r[0] for r in want]
    start, seen = 0, []
    for r in got:
        assert r.start == start
        start += r.n_tokens
        seen.append((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32))
    expected = [(-1 if d is None else d, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in ((d, ids_of(t)) for d, t in rows)]
    assert sorted(seen) == sorted(expected)
    back = {r.doc_id: r.ids for r in tk.read(spark, path).collect()}
    assert back[2] == ids_of(TEXTS[2]) and back[999] == ids_of("long word " * 20_000)
    assert spark.read.parquet(path).select("part", "block").distinct().count() > 5


def test_damage_is_found(spark, docs, tmp_path):
    tk.write(docs([(1, "some words here")]), f"{tmp_path}/a")
    bad = spark.read.parquet(f"{tmp_path}/a").selectExpr("part", "block", "before", "n_ids", "doc_ids", "known", "lengths", "coded", "crc + 1 as crc")
    bad.write.parquet(f"{tmp_path}/b")
    with pytest.raises(Exception, match="damaged"):
        tk.digest(spark, f"{tmp_path}/b").collect()


def test_empty(spark, docs, tmp_path):
    tk.write(docs([]), f"{tmp_path}/e")
    assert tk.digest(spark, f"{tmp_path}/e").count() == 0
    assert tk.read(spark, f"{tmp_path}/e").count() == 0


def test_blocks_end_with_the_document_that_fills_them(spark, docs, tmp_path, monkeypatch):
    monkeypatch.setattr(tk, "BLOCK", 10)
    tk.write(docs([(i, "a b c") for i in range(240)]), f"{tmp_path}/b")
    sizes = [r.n_ids for r in spark.read.parquet(f"{tmp_path}/b").collect()]
    assert sum(sizes) == 960 and max(sizes) == 12


def test_words_share_their_lower_case_and_marks_are_apart():
    tokenise = tk.Tokeniser()
    letters = [chr(c) for c in range(0xAA, 0x100) if chr(c).isalpha()]
    texts = ["That THAT, that that!!", "Été ÉTÉ été.", " ".join(letters), " ".join(c + "X;" for c in letters), "x" + "".join(letters)]
    ids, offsets = tokenise(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [ids_of(t) for t in texts]
    assert tokenise.known[:4] == ["that", ",", "!!", "été"]
    assert not [c for c in tokenise.known if c != c.lower()]


def test_frequent_chunks_outlast_the_cache(monkeypatch):
    monkeypatch.setattr(tk, "CACHE", 8)
    tokenise, asked = tk.Tokeniser(), []

    class Library:
        def encode_batch_fast(self, lines, **options):
            asked.extend(" ".join(lines).split())
            return lean.encode_batch_fast(lines, **options)

    lean, tokenise.lean = tokenise.lean, Library()
    for k in range(6):
        text = "often often also also " + " ".join(f"rare{'abcdefgh'[j]}{'uvwxyz'[k]}" for j in range(8))
        ids, _ = tokenise(pa.array([text]))
        assert ids.tolist() == ids_of(text)
    assert asked.count("often") == asked.count("also") == 1 and len(asked) == 50
    assert len(tokenise.known) <= 4 + 8


def test_long_chunks_go_and_leave_the_others_in_place():
    tokenise = tk.Tokeniser()
    for text in ("some words", "L" * 90 + " more, é" + "l" * 70 + "9 words 日本", "words 日本 " + "z" * 65 + "! more some"):
        ids, _ = tokenise(pa.array([text]))
        assert ids.tolist() == ids_of(text)
    assert tokenise.known == ["some", "words", "more", ",", "日本", "!"]
    assert len(tokenise.ids) == tokenise.sizes.sum() and len(tokenise.met) == 6


def test_lookup_of_order_0_equals_plain_search():
    rng = np.random.default_rng(2)
    models = tk.Models(1000)
    models.cumulative[1:] = np.cumsum(rng.integers(1, 1 << 40, 1000))
    for n in (1, 2, 4095, 4096):
        values = rng.integers(0, models.cumulative[-1], n)
        assert models.find(values).tolist() == (np.searchsorted(models.cumulative, values, "right") - 1).tolist()


def test_coded_bytes_stay_as_they_were():
    ids = np.random.default_rng(5).zipf(1.2, 70_000) % 49408
    ids[20_000:40_000] = ids[:20_000]
    assert zlib.crc32(tk.compress(ids)) == 3446449305
