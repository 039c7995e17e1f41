"""Token ids in binary files: an adaptive context-mixing range coder in independent blocks.

Documents are tokenised and their ids coded in ascending doc_id order. A block holds whole
documents of about ``BLOCK`` ids and is coded by itself: its models start empty and a checksum of
its ids is kept. Within a block the ids run in ``LANES`` lanes side by side, each a stream of its
own, so that numpy codes one id of every lane at a time; all lanes feed the same models.

For each id the two last ids predict one candidate (order 2) and the last id another (order 1),
each with a confidence; order 0 is the adaptive frequency of ids. How far each order is trusted is
learnt for every pair of confidences: the mixed interval is divided into a share for the order-2
candidate, one for the order-1 candidate, and one that order 0 divides among all ids. A carryless
range coder of 64 bits with 16-bit words codes these intervals.

The files are Parquet folders of blocks: part and block number, ids before the block in its part,
ids of documents and their lengths, coded bytes, checksum.

Text is tokenised by white-space chunks, which a tokeniser that never joins across white space
codes one by one; each worker keeps the chunks it has met, up to about ``CACHE`` of them, and then
those met more than once.

Defined results: a null text is empty; an empty text has only the end id; rows that repeat are
documents of their own; null ids come last; texts of any length are whole in one block. An empty
table gives no file rows. Other columns don't matter.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsflow.llm.common import partitions, shared_folder, shipped, slices, table, text_bytes
from obsflow.llm.registry import query

MODEL, END = public_tokenizers.path("word_bpe_49k.json"), 1
BLOCK, LANES, CACHE = 1 << 20, 4096, 900_000
#: Characters of the longest chunk that is kept, which bounds the bytes of all; bytes tokenised at a time.
LONG, GATHER = 64, 8 << 20
_TOP, _LEAST, _CHOICE = np.uint64(1 << 48), np.uint64(1 << 32), np.uint64(12)
_U = np.uint64


class Coder:
    """Ranges of all lanes; ``words`` out (encoding) or in (decoding, given with the number of each lane)."""

    def __init__(self, lanes: int, words: np.ndarray | None = None, sizes: np.ndarray | None = None):
        self.low = np.zeros(lanes, _U)
        self.range = np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
        self.at = np.zeros(lanes, np.int64)
        self.decoding = words is not None
        if self.decoding:
            self.words = np.zeros((lanes, int(sizes.max()) + 4), np.uint16)
            self.words[np.arange(self.words.shape[1]) < sizes[:, None]] = words
            self.code = np.zeros(lanes, _U)
            for k in range(4):
                self.code = self.code << _U(16) | self.words[:, k].astype(_U)
            self.at += 4
        else:
            self.words = np.zeros((lanes, 64), np.uint16)

    def narrow(self, lanes, start, share, unit) -> None:
        """Take ``share`` parts from ``start`` on, each ``unit`` wide, in the given lanes."""
        low = self.low[lanes] + unit * start
        width = unit * share
        differ = low ^ (low + width)
        at = np.flatnonzero((differ < _TOP) | (width < _LEAST))
        if len(at) and not self.decoding and self.at.max() + 8 > self.words.shape[1]:
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)
        differ = differ[at]
        while len(at):
            rows = at if isinstance(lanes, slice) else lanes[at]
            some, wide = low[at], width[at]
            cut = np.flatnonzero(differ >= _TOP)
            if len(cut):
                wide[cut] = (_U(0) - some[cut]) & (_LEAST - _U(1))
            place = self.at[rows]
            self.at[rows] = place + 1
            place += rows * self.words.shape[1]
            if self.decoding:
                self.code[rows] = self.code[rows] << _U(16) | self.words.ravel().take(place)
            else:
                self.words.ravel()[place] = some >> _U(48)
            some, wide = some << _U(16), wide << _U(16)
            low[at], width[at] = some, wide
            differ = some ^ (some + wide)
            more = np.flatnonzero((differ < _TOP) | (wide < _LEAST))
            at, differ = at[more], differ[more]
        self.low[lanes], self.range[lanes] = low, width

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Words of all lanes, one lane after the other, and the number of each."""
        for k in range(4):
            if self.at.max() + 1 > self.words.shape[1]:
                self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)
            self.words[np.arange(len(self.at)), self.at] = (self.low >> _U(48 - 16 * k)) & _U(0xFFFF)
            self.at += 1
        return self.words[np.arange(self.words.shape[1]) < self.at[:, None]], self.at


class Models:
    """What the lanes of a block have learnt together."""

    SLOTS, GAIN, REBUILD = 1 << 17, 24, 4
    #: What is added to a candidate by how sure it is (0 to 3), after a miss and after a hit.
    CHANGE = np.array([0, -1, -1, -2, 1, 1, 1, 0], np.int32)

    def __init__(self, alphabet: int):
        # A candidate and, in the two low bits, how sure it is: of the order-2 slots, then of each id.
        self.candidates = np.zeros(self.SLOTS + alphabet, np.int32)
        self.choices = np.tile(np.array([4, 2, 6], np.int64), (32, 1))
        self.weights = np.ones(alphabet, np.int64)
        self.cumulative = np.zeros(alphabet + 1, np.int64)
        self.steps = 0

    def predict(self, before: np.ndarray, last: np.ndarray) -> None:
        """Candidates and context of each lane."""
        self.at = np.empty((2, len(last)), np.int64)
        # Wraps around in 32 bits, which leaves the low ones as they are.
        np.bitwise_and(last * np.int32(40503) + before * np.int32(60493), self.SLOTS - 1, out=self.at[0])
        np.add(last, self.SLOTS, out=self.at[1])
        self.was = self.candidates.take(self.at)
        self.guess, self.sure = self.was >> 2, self.was & 3
        self.context = (self.sure[0] << 2) + self.sure[1] + ((self.guess[0] == self.guess[1]).astype(np.int32) << 4)
        if self.steps % self.REBUILD == 0:
            np.cumsum(self.weights, out=self.cumulative[1:])
        self.steps += 1
        self.starts, self.shares = np.zeros((32, 3), _U), np.empty((32, 3), _U)
        self.shares[:, :2] = 1 + self.choices[:, :2] * ((1 << 12) - 3) // self.choices.sum(axis=1, keepdims=True)
        self.starts[:, 1] = self.shares[:, 0]
        self.starts[:, 2] = self.shares[:, 0] + self.shares[:, 1]
        self.shares[:, 2] = _U(1 << 12) - self.starts[:, 2]

    def interval(self, choice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of each lane's choice."""
        self.chosen = self.context * 3 + choice
        return self.starts.ravel().take(self.chosen), self.shares.ravel().take(self.chosen)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Ids whose order-0 interval holds each value; looked up in rising order, which is faster."""
        bits = len(values).bit_length()
        order = np.sort(values << bits | np.arange(len(values)))
        ids = np.empty(len(values), np.int64)
        ids[order & ((1 << bits) - 1)] = np.searchsorted(self.cumulative, order >> bits, "right") - 1
        return ids

    def learn(self, ids: np.ndarray, missed: np.ndarray) -> None:
        """All ``ids``, and those that no candidate named."""
        self.choices += np.bincount(self.chosen, minlength=96).reshape(32, 3)
        if self.steps % 32 == 0:
            self.choices -= self.choices // 4
        np.add.at(self.weights, missed, self.GAIN)
        # A hit is surer by one; a miss halves that, and replaces a candidate that is not sure.
        case = self.sure + ((self.guess == ids).astype(np.int32) << 2)
        self.was += self.CHANGE.take(case)
        np.copyto(self.was, ids << 2, where=case == 0)
        self.candidates[self.at] = self.was


def _lanes(n: int) -> tuple[int, int]:
    """Steps, and lanes that are in use; the last lane may be shorter."""
    steps = max(64, -(-n // LANES))
    return steps, -(-n // steps)


def compress(ids: np.ndarray) -> bytes:
    """One block: number of ids, alphabet, then length and words of each lane."""
    n = len(ids)
    alphabet = int(ids.max(initial=0)) + 1
    head = np.array([n, alphabet], "<u4").tobytes()
    if not n:
        return head
    steps, lanes = _lanes(n)
    grid = np.zeros(steps * lanes, np.int32)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    tail = n - (lanes - 1) * steps
    coder, models = Coder(lanes), Models(alphabet)
    before, last = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    for step in range(steps):
        used = lanes if step < tail else lanes - 1
        if not used:
            break
        x = grid[step, :used]
        models.predict(before[:used], last[:used])
        choice = np.where(models.guess[0] == x, 0, 2 - (models.guess[1] == x))
        coder.narrow(slice(0, used), *models.interval(choice), coder.range[:used] >> _CHOICE)
        miss = np.flatnonzero(choice == 2)
        missed = x[miss].astype(np.int64)
        if len(miss):
            start = models.cumulative[missed]
            share = models.cumulative[missed + 1] - start
            coder.narrow(miss, start.astype(_U), share.astype(_U), coder.range[miss] // _U(models.cumulative[-1]))
        models.learn(x, missed)
        before, last = last, grid[step]
    words, sizes = coder.finish()
    return head + sizes.astype("<u4").tobytes() + words.astype("<u2").tobytes()


def decompress(data: bytes) -> np.ndarray:
    n, alphabet = np.frombuffer(data, "<u4", 2).tolist()
    if not n:
        return np.zeros(0, np.int64)
    steps, lanes = _lanes(n)
    sizes = np.frombuffer(data, "<u4", lanes, 8)
    coder, models = Coder(lanes, np.frombuffer(data, "<u2", -1, 8 + 4 * lanes), sizes), Models(alphabet)
    grid = np.zeros((steps, lanes), np.int32)
    tail = n - (lanes - 1) * steps
    before, last = np.zeros(lanes, np.int32), np.zeros(lanes, np.int32)
    for step in range(steps):
        used = lanes if step < tail else lanes - 1
        if not used:
            break
        models.predict(before[:used], last[:used])
        unit = coder.range[:used] >> _CHOICE
        value = coder.code[:used] - coder.low[:used]
        choice = (value >= unit * models.starts[:, 1].take(models.context)).astype(np.int64)
        choice += value >= unit * models.starts[:, 2].take(models.context)
        x = np.where(choice == 0, models.guess[0], models.guess[1])
        coder.narrow(slice(0, used), *models.interval(choice), unit)
        miss = np.flatnonzero(choice == 2)
        missed = miss
        if len(miss):
            total = models.cumulative[-1]
            unit = coder.range[miss] // _U(total)
            value = np.minimum((coder.code[miss] - coder.low[miss]) // unit, _U(total - 1)).astype(np.int64)
            missed = models.find(value)
            x[miss] = missed
            start = models.cumulative[missed]
            share = models.cumulative[missed + 1] - start
            coder.narrow(miss, start.astype(_U), share.astype(_U), unit)
        models.learn(x, missed)
        grid[step, :used] = x
        before, last = last, grid[step]
    return grid.T.astype(np.int64, order="C").ravel()[:n]


#: What word_bpe_49k.json does before its merges; only then are plain words taken apart from the rest.
_NORMALIZERS, _SUFFIX = ["NFC", "Replace", "Lowercase"], "</w>"
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters that only need lower case, these in lower case, and the marks taken off behind them, at most so many.
_LETTERS, _LOWER = "^[A-Za-zªµºÀ-ÖØ-öø-ÿ]+$", "^[a-zªµºß-öø-ÿ]+$"
_MARKS, _MOST = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~', 8


def _runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs of the given beginnings and sizes, one run after the other."""
    ends = np.cumsum(sizes)
    places = np.repeat(begins - (ends - sizes), sizes)
    places += np.arange(len(places))
    return places


class Tokeniser:
    """Ids of batches of texts; keeps the chunks it has met.

    Most chunks are one word of Latin letters, perhaps with a run of marks behind it: the words need
    nothing but lower case and the merges, and are coded many at a time by a copy of the model
    without the rest; the marks are a chunk of their own. The library codes all others.
    """

    def __init__(self, path: str = MODEL):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [n.get("type") for n in (spec["normalizer"] or {}).get("normalizers", [])]
        splits = [p.get("pattern") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        self.plain = (kinds == _NORMALIZERS and splits[:1] == [{"Regex": _PATTERN}]
                      and spec["model"].get("end_of_word_suffix") == _SUFFIX)
        if self.plain:
            lean = spec | {"normalizer": None, "added_tokens": [], "pre_tokenizer": {
                "type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {
                    "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}
            self.lean = Tokenizer.from_str(json.dumps(lean))
            vocabulary = self.lean.get_vocab()
            self.last = np.zeros(max(vocabulary.values()) + 1, bool)
            self.last[[i for t, i in vocabulary.items() if t.endswith(_SUFFIX)]] = True
        # The chunks met, how often, and where the ids of each begin in ``ids`` and how many they are.
        self.chunks, self.met = pa.array([], pa.large_string()), np.zeros(0, np.int64)
        self.begins, self.sizes, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    @property
    def known(self) -> list[str]:
        return self.chunks.to_pylist()

    def _keep(self, stay: np.ndarray, start: int = 0) -> None:
        """Forget the chunks from ``start`` on that don't stay; their ids are the last ones."""
        at = np.flatnonzero(stay) + start
        sizes, first = self.sizes[at], len(self.ids) - int(self.sizes[start:].sum())
        self.ids = np.concatenate([self.ids[:first], self.ids[_runs(self.begins[at], sizes)]])
        self.begins = np.concatenate([self.begins[:start], first + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes[:start], sizes])
        self.met = np.concatenate([self.met[:start], self.met[at]])
        self.chunks = pa.concat_arrays([self.chunks.slice(0, start), self.chunks.take(pa.array(at))])

    def _forget(self) -> None:
        """Keep what was met more than once, the most frequent ones if these are many."""
        half = CACHE // 2
        least = max(1, int(np.partition(self.met, -half - 1)[-half - 1]))
        self._keep(self.met > least)
        self.met //= 2

    def _learn(self, fresh: pa.Array) -> None:
        """Ids of ``fresh``, which come behind the chunks met; lower-case words of letters by the copy."""
        plain = pc.match_substring_regex(fresh, _LOWER).to_numpy(zero_copy_only=False) & self.plain
        words, rest = (fresh.filter(pa.array(some)).to_pylist() for some in (plain, ~plain))
        lines = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
        coded = [np.array(e.ids, np.int32) for e in self.lean.encode_batch_fast(lines, add_special_tokens=False)] if lines else []
        ids = np.concatenate([np.zeros(0, np.int32), *coded])
        ends = np.flatnonzero(self.last[ids]) + 1 if lines else np.zeros(0, np.int64)
        if len(ends) != len(words):  # every word ends with a token that says so
            raise ValueError("the tokeniser does not mark the ends of words")
        coded = [e.ids for start in range(0, len(rest), 1000)
                 for e in self.model.encode_batch_fast(rest[start : start + 1000], add_special_tokens=False)]
        sizes = np.concatenate([np.diff(ends, prepend=0), np.fromiter(map(len, coded), np.int64, len(coded))])
        order = np.argsort(np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)]))
        self.begins = np.concatenate([self.begins, (len(self.ids) + np.cumsum(sizes) - sizes)[order]])
        self.sizes = np.concatenate([self.sizes, sizes[order]])
        self.ids = np.concatenate([self.ids, ids, np.array([i for some in coded for i in some], np.int32)])

    def _apart(self, chunks: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Chunks with plain words in lower case and the marks behind them as chunks of their own; the chunks that had some."""
        if not self.plain:
            return chunks, np.zeros(0, np.int64)
        heads = pc.ascii_rtrim(chunks, _MARKS)
        cut = (pc.binary_length(chunks).to_numpy() - pc.binary_length(heads).to_numpy()).astype(np.int64)
        plain = pc.match_substring_regex(heads, _LETTERS).to_numpy(zero_copy_only=False) & (cut <= _MOST)
        # Lower case leaves the marks and, for these letters, the number of bytes as they are.
        data, offsets = text_bytes(pc.if_else(pa.array(plain), pc.utf8_lower(chunks), chunks))
        at = np.flatnonzero(plain & (cut > 0))
        offsets = np.insert(offsets, at + 1, offsets[at + 1] - cut[at])
        return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data)), at

    def __call__(self, texts: pa.Array, end: int | None = END) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, ``end`` after each text, and the n + 1 offsets."""
        if len(self.chunks) > CACHE:
            self._forget()
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        chunks, at = self._apart(split.flatten())
        # The chunks met come first and so keep their places; the new ones follow.
        met = len(self.chunks)
        coded = pa.concat_arrays([self.chunks, chunks]).dictionary_encode()
        self.chunks = coded.dictionary
        self._learn(self.chunks.slice(met))
        places = coded.indices.to_numpy(zero_copy_only=False)[met:]
        self.met = np.bincount(places, minlength=len(self.chunks)) + np.pad(self.met, (0, len(self.chunks) - met))
        each = self.sizes[places]
        ends = np.concatenate([[0], np.cumsum(each)])
        ids = self.ids[_runs(self.begins[places], each)]
        long = pc.utf8_length(self.chunks.slice(met)).to_numpy(zero_copy_only=False) > LONG
        if long.any():
            self._keep(~long, met)
        stops = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        offsets = ends[stops + np.searchsorted(at, stops)]
        if end is None:
            return ids, offsets
        return np.insert(ids, offsets[1:], end), offsets + np.arange(len(offsets))


@lru_cache(maxsize=2)
def tokeniser(path: str = MODEL) -> Tokeniser:
    """One for all tasks of a worker."""
    return Tokeniser(path)


_FILE = "part int, block int, before long, n_ids long, doc_ids binary, known binary, lengths binary, coded binary, crc long"


def _gathered(batches):
    """Texts and doc ids, some ``GATHER`` bytes of text at a time."""
    texts, docs, size = [], [], 0
    for batch in batches:
        for some in slices(batch, "text", 2 << 20):
            texts.append(some.column("text").cast(pa.large_string()))
            docs += some.column("doc_id").to_pylist()
            size += texts[-1].nbytes
            if size >= GATHER:
                yield pa.concat_arrays(texts), docs
                texts, docs, size = [], [], 0
    if docs:
        yield pa.concat_arrays(texts), docs


def _code(path: str, end: int | None):
    def run(batches):
        part, block, before = TaskContext.get().partitionId(), 0, 0
        tokenise = tokeniser(path)
        ids, lengths, docs, size = [], [], [], 0

        def flush():
            nonlocal block, before, ids, lengths, docs, size
            every = np.concatenate(ids)
            row = {"part": part, "block": block, "before": before, "n_ids": len(every),
                   "doc_ids": np.array([d or 0 for d in docs], "<i8").tobytes(),
                   "known": np.array([d is not None for d in docs], np.uint8).tobytes(),
                   "lengths": np.concatenate(lengths).astype("<i8").tobytes(), "coded": compress(every),
                   "crc": zlib.crc32(every.astype("<u4").tobytes())}
            block, before, ids, lengths, docs, size = block + 1, before + len(every), [], [], [], 0
            kinds = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), *(
                (c, pa.binary()) for c in ("doc_ids", "known", "lengths", "coded")), ("crc", pa.int64())])
            return pa.RecordBatch.from_pylist([row], kinds)

        for texts, names in _gathered(batches):
            found, offsets = tokenise(texts, end)
            start = 0
            while start < len(names):  # a block ends with the document that fills it
                stop = min(len(names), int(np.searchsorted(offsets, offsets[start] + BLOCK - size)))
                stop = max(stop, start + 1)
                ids.append(found[offsets[start] : offsets[stop]])
                lengths.append(np.diff(offsets[start : stop + 1]))
                docs += names[start:stop]
                size += len(ids[-1])
                start = stop
                if size >= BLOCK:
                    yield flush()
        if docs:
            yield flush()
    return run


def write(docs: DataFrame, path: str, model: str = MODEL, end: int | None = END) -> None:
    """Tokenise and write all documents in ascending doc_id order."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    sorted_ = rows.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    shipped(sorted_).mapInArrow(_code(model, end), _FILE).write.parquet(path)


def _blocks(batches):
    """(part, before, ids, offsets, doc ids, known) of each block; fails on a wrong checksum."""
    for batch in batches:
        for row in range(batch.num_rows):
            value = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
            ids = decompress(value["coded"])
            if zlib.crc32(ids.astype("<u4").tobytes()) != value["crc"]:
                raise ValueError(f"block {value['block']} of part {value['part']} is damaged")
            offsets = np.concatenate([[0], np.cumsum(np.frombuffer(value["lengths"], "<i8"))])
            docs = pa.array(np.frombuffer(value["doc_ids"], "<i8"), mask=np.frombuffer(value["known"], np.uint8) == 0)
            yield value["part"], value["before"], ids, offsets, docs


def _file_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(StructType.fromDDL(_FILE)).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of every document."""
    def run(batches):
        for _, _, ids, offsets, docs in _blocks(batches):
            lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([docs, lists], names=["doc_id", "ids"])

    return shipped(_file_rows(spark, path)).mapInArrow(run, "doc_id long, ids array<int>")


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, from the files."""
    def run(batches):
        for part, before, ids, offsets, docs in _blocks(batches):
            raw = ids.astype("<u4").tobytes()
            crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(docs), part, np.int32)), docs, pa.array(before + offsets[:-1]),
                 pa.array(np.diff(offsets)), pa.array(crcs, pa.int64())],
                names=["part", "doc_id", "local", "n_tokens", "ids_crc32"])

    rows = _file_rows(spark, path)
    found = shipped(rows).mapInArrow(run, "part int, doc_id long, local long, n_tokens long, ids_crc32 long")
    totals = rows.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part: small enough to send to every task at any size of the input.
    shift = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    return found.join(F.broadcast(shift), "part").select(
        "doc_id", (F.col("local") + F.col("shift")).alias("start"), "n_tokens", "ids_crc32")


@query("op2_token_files")
def op2_token_files(spark, sf_dir):
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), path)
    return digest(spark, path)
