import random

import numpy as np
import pyarrow as pa
import sentencepiece as library

from obsflow.llm import sentencepiece as sp

TEXTS = ["", " ", "  a  b\n\tc ", "Hello world", "ünïcödé 日本語 🙂 \u0000x", "a" * 300, "the the the", "▁", "naïve\r\n\r\nx", "1234  5"]


def brute(part: bytes, model):
    """Best score and the ids, longest last pieces first where scores tie, by full recursion."""
    table = {n: i for i, (n, k) in enumerate(zip(model.names, model.kinds)) if k == model.NORMAL}
    best = {0: (0.0, [])}
    text, at = part.decode(), [0]
    for c in text:
        at.append(at[-1] + len(c.encode()))
    for k, end in enumerate(at[1:], 1):
        found = []
        for start in at[:k]:
            piece = part[start:end]
            if piece in table:
                found.append((best[start][0] + model.scores[table[piece]], best[start][1] + [table[piece]]))
        if part[at[k - 1]:end] not in table:
            found.append((best[at[k - 1]][0] + sp.BYTE_SCORE * (end - at[k - 1]),
                          best[at[k - 1]][1] + [model.bytes[b] for b in part[at[k - 1]:end]]))
        best[end] = max(found, key=lambda f: f[0])
    return best[len(part)][1]


def test_viterbi():
    model, rng = sp.pieces(), random.Random(4)
    alphabet = "aeinrst▁▁ ,.\né日🙂ThK19"
    encoder = sp.Encoder()
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    ids, offsets = encoder(pa.array(texts))
    for k, text in enumerate(texts):
        marked = ("▁" + text.replace(" ", "▁")).encode() if text else b""
        assert ids[offsets[k]:offsets[k + 1]].tolist() == brute(marked, model), text


def test_against_library(tmp_path):
    """The library takes the same pieces as a unigram model once its file says so."""
    with open(sp.MODEL, "rb") as file:
        raw = file.read()
    spec = next(v for f, v in sp._fields(raw) if f == 2)
    at = raw.index(spec)
    kind = spec.index(bytes([3 << 3, 2]))  # model_type: BPE
    changed = raw[: at + kind + 1] + b"\x01" + raw[at + kind + 2 :]
    other = library.SentencePieceProcessor(model_proto=changed)
    path = tmp_path / "unigram.model"
    path.write_bytes(changed)
    model, encoder = sp.pieces(str(path)), sp.Encoder(str(path))
    assert model.scores[model.names.index(b"in")] == other.get_score(other.piece_to_id("in"))
    texts = ["Thonst aonthrein thedtiou anon.", "In, of the inanin.", "Hello world", "der Rest: 12 km"]
    for text in texts:
        ours = encoder(pa.array([text]))[0].tolist()
        total = lambda ids: sum(model.scores[i] for i in ids)
        theirs = other.encode(text)
        assert abs(total(ours) - total(theirs)) < 1e-3 or total(ours) > total(theirs)
        assert other.decode(ours) == text


def test_ranks_become_log_shares():
    """The pieces of the merge model get shares that fall with their rank and add up to one."""
    model = sp.pieces()
    raw = library.SentencePieceProcessor(model_file=sp.MODEL)
    normal = [i for i, k in enumerate(model.kinds) if k == model.NORMAL]
    assert abs(sum(np.exp(model.scores[i]) for i in normal) - 1) < 1e-9
    order = sorted(normal, key=lambda i: -model.scores[i])
    ranks = [raw.get_score(i) for i in order]
    assert ranks == sorted(ranks, reverse=True)
    assert abs(model.scores[order[0]] - model.scores[order[9]] - np.log(10)) < 1e-12


def test_trie():
    words = {b"a": 0, b"ab": 1, b"abc": 2, b"\xff": 3, b"b": 4, b"\x00": 5}
    trie = sp.Trie(words)

    def find(word):
        state = 0
        for byte in word:
            child = trie.base[state] + byte
            if child >= len(trie.check) or child == 0 or trie.check[child] != state:
                return None
            state = child
        return trie.value[state]
    assert {w: find(w) for w in words} == words
    assert find(b"ac") is None and find(b"abcd") is None and find(b"c") is None


def test_round_trip(docs):
    rows = list(enumerate(TEXTS)) + [(50, None), (None, "x y"), (50, None), (60, "long word " * 30_000)]
    df = sp.round_trip(docs([(*r, "s", 1) for r in rows], ", piece int"))
    got = {(r.doc_id, r.n_tokens): r for r in df.collect()}
    assert {r.doc_id for r in got.values() if not r.exact} == {7}  # the text with a marker
    assert got[(50, 0)].token_ids == [] and got[(50, 0)].ids_crc32 == 0
    coded = sp.encode(docs(rows))
    assert coded.columns == docs(rows).columns + ["token_ids", "n_tokens"]
    texts = {r.doc_id: r for r in sp.decode(coded).collect()}
    assert texts[2].decoded == TEXTS[2] and texts[50].text is None and texts[50].decoded == ""
    assert sp.round_trip(docs([])).count() == 0
    assert sp.pieces().decode(texts[4].token_ids) == TEXTS[4]
    assert sp.Decoder()(np.array([sp.pieces().bytes[255]], np.int32), np.array([0, 1])).to_pylist() == ["�"]
