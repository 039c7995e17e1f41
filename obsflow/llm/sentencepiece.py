"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

White space becomes the marker U+2581, one marker goes before a non-empty text, and the best
segmentation is the one with the greatest sum of piece scores; characters that no piece covers are
spelled with the byte pieces. Of segmentations of equal score the one whose last piece is longest,
then the one before it, and so on, is taken. Decoding joins pieces and bytes, turns markers into
spaces and drops the first one, so a text comes back to the byte unless it holds the marker itself
(that comes back as a space).

No piece has a marker after another character, so a text splits exactly before each run of markers
and equal parts share their ids; each task keeps the parts it has met, up to ``CACHE`` of them.

The pieces are read from a model file of the sentencepiece library, whose path is a parameter. A
unigram model's scores are log probabilities and taken as they are. The default one is a BPE model,
whose scores are merge ranks: its pieces get the log of the share that Zipf's law gives their rank,
1 / rank over the sum of all, so the ids are the most likely segmentation under these shares, not
that model's BPE ids. Pieces are not counted in the corpus, which would take a second pass.

Defined results: a null text is empty; an empty text has no ids; rows that repeat get the same
ids; texts of any length are encoded whole; an empty table gives an empty result. Other columns
are kept.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import shipped, slices, table, with_fields
from obsflow.llm.registry import query

MODEL = public_tokenizers.path("piece_bpe_32k.model")
#: Parts kept at most, and the characters of the longest one kept, which bounds their bytes.
MARK, CACHE, LONG = "▁", 500_000, 64
#: Score of one byte piece, below any score of a piece.
BYTE_SCORE = -1e9


class Trie:
    """Double-array trie over UTF-8 bytes: child of state s by byte b is ``base[s] + b`` where
    ``check`` of it is s; ``value`` is the id of the piece that ends in a state, or -1."""

    def __init__(self, pieces: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ids = [-1]
        for piece, number in pieces.items():
            node = 0
            for byte in piece:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                    ids.append(-1)
                node = children[node][byte]
            ids[node] = number
        size = 2 * len(children) + 512
        base, check, value = [0] * size, [-1] * size, [-1] * size
        # Long searches move the point where later ones begin, so building stays linear.
        check[0], free, hint, todo = 0, 257, 257, [(0, 0)]
        for node, state in todo:
            value[state] = ids[node]
            if not children[node]:
                continue
            keys = sorted(children[node])
            begin = at = (free if len(keys) == 1 else hint) - keys[0]
            while any(check[at + key] != -1 for key in keys):
                at += 1
                if at + 256 > len(check):
                    base, check, value = (x + [fill] * size for x, fill in ((base, 0), (check, -1), (value, -1)))
            if at > begin + 50 and len(keys) > 1:
                hint = max(hint, at + keys[0])
            base[state] = at
            for key in keys:
                check[at + key] = state
                todo.append((children[node][key], at + key))
            while check[free] != -1:
                free += 1
        self.base, self.check, self.value = base, check, value


def _fields(data: bytes):
    """(number, value) of each field of a protocol buffer message."""
    at = 0

    def number():
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        key = number()
        kind = key & 7
        size = number() if kind == 2 else {1: 8, 5: 4}.get(kind, 0)
        if kind == 0:
            yield key >> 3, number()
        else:
            yield key >> 3, data[at : at + size]
            at += size


class Pieces:
    """Pieces, scores and kinds of a model file, with encoding and decoding of single texts."""

    NORMAL, BYTE = 1, 6
    BPE = 2

    def __init__(self, path: str = MODEL):
        self.names, self.scores, self.kinds = [], [], []
        trained = {}
        with open(path, "rb") as file:
            for field, value in _fields(file.read()):
                if field == 2:
                    trained = dict(_fields(value))
                if field == 1:
                    piece = dict(_fields(value))
                    self.names.append(piece[1])
                    self.scores.append(float(np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]))
                    self.kinds.append(piece.get(3, self.NORMAL))
        if trained.get(3) == self.BPE:
            self._rank()
        normal = {n: i for i, (n, k) in enumerate(zip(self.names, self.kinds)) if k == self.NORMAL}
        self.trie = Trie(normal)
        self.bytes = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(self.names, self.kinds)) if k == self.BYTE}
        if len(self.bytes) != 256:
            raise ValueError("the model has no byte pieces")
        mark = MARK.encode()
        if any(mark in n.lstrip(mark) for n in normal):
            raise ValueError("pieces go on beyond a marker")
        self.spelled = [n.replace(mark, b" ") if k == self.NORMAL else b"" for n, k in zip(self.names, self.kinds)]
        for byte, i in self.bytes.items():
            self.spelled[i] = bytes([byte])

    def _rank(self) -> None:
        """The log shares of the pieces by their ranks, the highest score first."""
        ranked = [i for i, kind in enumerate(self.kinds) if kind == self.NORMAL]
        ranked.sort(key=lambda i: -self.scores[i])
        total = sum(1 / rank for rank in range(1, len(ranked) + 1))
        for rank, i in enumerate(ranked, 1):
            self.scores[i] = -math.log(rank * total)

    def best(self, part: bytes) -> list[int]:
        """Viterbi ids of a part whose white space is marked."""
        base, check, value, scores = self.trie.base, self.trie.check, self.trie.value, self.scores
        size, n = len(check), len(part)
        best: list = [None] * (n + 1)
        best[0] = 0.0
        back: list = [None] * (n + 1)
        at = 0
        while at < n:
            here, state, end = best[at], 0, at
            first = part[at]
            width = 1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4
            whole = False
            while end < n:
                child = base[state] + part[end]
                if child >= size or check[child] != state or child == 0:
                    break
                state = child
                end += 1
                piece = value[state]
                if piece >= 0:
                    whole = whole or end == at + width
                    total = here + scores[piece]
                    # An earlier start is the longer piece and keeps its place where scores tie.
                    if best[end] is None or total > best[end]:
                        best[end], back[end] = total, (at, piece)
            if not whole:
                end = at + width
                total = here + BYTE_SCORE * width
                if best[end] is None or total > best[end]:
                    best[end], back[end] = total, (at, -1)
            at += width
        out = []
        while n:
            start, piece = back[n]
            out.extend([piece] if piece >= 0 else [self.bytes[b] for b in reversed(part[start:n])])
            n = start
        return out[::-1]

    def decode(self, ids) -> str:
        text = b"".join([self.spelled[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text


@lru_cache(maxsize=2)
def pieces(path: str = MODEL) -> Pieces:
    return Pieces(path)


class Encoder:
    """Encodes batches; keeps the ids of the parts it has met."""

    def __init__(self, path: str = MODEL):
        self.pieces, self.known = pieces(path), {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and the n + 1 offsets."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        marked = pc.replace_substring(texts, " ", MARK)
        large = lambda x: pa.scalar(x, pa.large_string())
        marked = pc.if_else(pc.equal(texts, ""), large(""), pc.binary_join_element_wise(large(MARK), marked, large("")))
        # A part is a run of markers with what follows up to the next one.
        split = pc.split_pattern_regex(pc.replace_substring_regex(marked, f"([^{MARK}]){MARK}", rf"\1 {MARK}"), " ")
        coded = split.flatten().dictionary_encode()
        if len(self.known) > CACHE:
            self.known = {}
        known, best = self.known, self.pieces.best
        parts = []
        for part in coded.dictionary.to_pylist():
            ids = known.get(part)
            if ids is None:
                ids = np.array(best(part.encode()), np.int32)
                if len(part) <= LONG:
                    known[part] = ids
            parts.append(ids)
        sizes = np.array([len(p) for p in parts], np.int64)
        flat = np.concatenate([np.zeros(0, np.int32), *parts])
        begins = np.cumsum(sizes) - sizes
        which = coded.indices.to_numpy(zero_copy_only=False)
        each = sizes[which]
        ends = np.cumsum(each)
        ids = flat[np.repeat(begins[which] - (ends - each), each) + np.arange(int(ends[-1]) if len(ends) else 0)]
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        return ids, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]


class Decoder:
    def __init__(self, path: str = MODEL):
        spelled = pieces(path).spelled
        self.sizes = np.array([len(s) for s in spelled], np.int64)
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.begins = np.cumsum(self.sizes) - self.sizes

    def __call__(self, ids: np.ndarray, offsets: np.ndarray) -> pa.Array:
        """Texts of lists of ids; bytes that are not UTF-8 are replaced."""
        each = self.sizes[ids]
        ends = np.concatenate([[0], np.cumsum(each)])
        data = self.flat[np.repeat(self.begins[ids] - ends[:-1], each) + np.arange(ends[-1])]
        bounds = ends[offsets].tolist()
        raw = data.tobytes()
        out = []
        for start, end in zip(bounds[:-1], bounds[1:]):
            text = raw[start:end].decode("utf-8", "replace")
            out.append(text[1:] if text[:1] == " " else text)
        return pa.array(out, pa.string())


def encode(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` with token_ids and n_tokens."""
    docs, schema = with_fields(docs, "token_ids array<int>, n_tokens long")
    as_text = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches):
        encoder = Encoder(path)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                ids, offsets = encoder(part.column("text"))
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([*part.columns, lists, pa.array(np.diff(offsets))], names=schema.names)

    return shipped(as_text).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str = MODEL) -> DataFrame:
    """``coded`` with decoded, the text of its token_ids; null ids count as none."""
    coded, schema = with_fields(coded, "decoded string")

    def run(batches):
        decoder = Decoder(path)
        for batch in batches:
            lists = pc.fill_null(batch.column("token_ids"), pa.scalar([], pa.list_(pa.int32())))
            counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
            texts = decoder(lists.flatten().to_numpy(zero_copy_only=False), offsets)
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], names=schema.names)

    return shipped(coded).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str = MODEL) -> DataFrame:
    """``docs`` without text, with token_ids, n_tokens, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers) and exact: whether decoding the ids gives the text back.

    Batches are encoded and decoded in one pass, so the texts cross to Python once.
    """
    others, schema = with_fields(docs.drop("text"), "token_ids array<int>, n_tokens long, ids_crc32 long, exact boolean")
    kept = others.columns
    as_text = docs.select(*kept, F.col("text").cast("string").alias("text"))

    def run(batches):
        encoder, decoder = Encoder(path), Decoder(path)
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                texts = pc.fill_null(part.column("text"), "")
                ids, offsets = encoder(texts)
                raw = ids.astype("<u4").tobytes()
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids))
                exact = pc.equal(decoder(ids, offsets), texts)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), lists, pa.array(np.diff(offsets)), pa.array(crcs, pa.int64()), exact],
                    names=schema.names)

    return shipped(as_text).mapInArrow(run, schema)


@query("op7_sentencepiece")
def op7_sentencepiece(spark, sf_dir):
    """doc_id, token_ids, n_tokens, ids_crc32 and exact of every document."""
    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"))
