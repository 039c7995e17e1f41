"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting goes round the features in a fixed cycle; each turn fits a tree of at most three leaves on
one binned feature and adds a small step of it to that feature's lookup table. Then the pairs with
the largest gain left get two-way tables in the same manner. A score is an intercept plus one
looked-up number per feature and pair, so a batch is scored by adding up columns of table values.

The model is fitted on the driver on at most ``max_rows`` labelled rows, those of least hash; the
features of all documents are counted in numpy within the tasks.

Defined results: null and empty texts have the features of a text without words and get a score
like any other; labels without a document, or null, teach nothing; with no label at all the score
is 0.5, with one class the smoothed share of that class. Rows that repeat get the same score; an
empty table gives an empty result. A null id counts as the empty text. Other columns don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import (
    IS_SPACE, sequence_hashes, shingle_hashes, shipped, slices, span_hashes, table, text_bytes, with_fields, words_of,
)
from obsflow.llm.registry import query

NAMES = (
    "words", "word_length", "upper", "digits", "marks", "bangs", "bars", "rare_marks", "high_bytes", "spaces",
    "distinct_words", "distinct_pairs", "same_as_before", "top_word", "again", "sentence_length", "line_length",
    "marked_words", "upper_words",
)
_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "marks": b".,;:'\"()-?", "bangs": b"!",
    "bars": b"|", "rare_marks": b"*#%&$@^~<>{}[]_+=/\\", "high_bytes": bytes(range(128, 256)), "spaces": b" \t\n\v\f\r",
}


def _members(values: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values)] = True
    return out


def _uniques(owner: np.ndarray, hashes: np.ndarray):
    """Index of the first of each (text, hash), and how often it occurs."""
    key = hashes ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, index, counts = np.unique(key, return_index=True, return_counts=True)
    return index, counts


def features(texts: pa.Array) -> np.ndarray:
    """A row of ``NAMES`` for each text."""
    data, offsets = text_bytes(texts)
    n = len(texts)
    starts, ends, owner = words_of(data, offsets)
    count = lambda who, weights=None: np.bincount(who, weights, minlength=n).astype(float)
    size, words = np.maximum(np.diff(offsets), 1).astype(float), count(owner)
    some = np.maximum(words, 1)
    out = {"words": np.log1p(words), "word_length": count(owner, ends - starts) / some}
    for name, members in _KINDS.items():
        sums = np.concatenate([[0], np.cumsum(_members(members)[data])])
        out[name] = np.diff(sums[offsets]) / size
    hashes = span_hashes(data, starts, ends)
    index, counts = _uniques(owner, hashes)
    out["distinct_words"] = count(owner[index]) / some
    top = np.zeros(n)
    np.maximum.at(top, owner[index], counts)
    out["top_word"] = top / some
    pairs, whose = shingle_hashes(hashes, owner, 2, n)
    out["distinct_pairs"] = count(whose[_uniques(whose, pairs)[0]]) / np.maximum(count(whose), 1)
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out["same_as_before"] = count(owner[same]) / some
    lines = np.concatenate([[0], np.cumsum(data == 10)])
    last = np.ones(len(starts), bool)
    line = np.ones(len(starts), bool)
    if len(starts):
        line[:-1] = (owner[1:] != owner[:-1]) | (lines[starts[1:]] > lines[ends[:-1]])
        last[:-1] = line[:-1] | _members(b".!?")[data[ends[:-1] - 1]]
    stop = np.flatnonzero(last) + 1
    begin = np.concatenate([[0], stop[:-1]])[: len(stop)]
    text = owner[begin] if len(stop) else owner
    first = np.zeros(len(stop), bool)
    if len(stop):
        first[_uniques(text, sequence_hashes(hashes, begin, stop))[0]] = True
    out["again"] = count(text[~first], (stop - begin)[~first]) / some
    out["sentence_length"] = words / np.maximum(count(text), 1)
    out["line_length"] = words / np.maximum(count(owner[line]), 1)
    ascii_word = ~IS_SPACE & ~_members(b"abcdefghijklmnopqrstuvwxyz.,;:'\"()-?" + _KINDS["upper"] + _KINDS["high_bytes"] + _KINDS["digits"])
    out["marked_words"] = count(owner[ascii_word[data[ends - 1]]]) / some if len(ends) else some * 0
    upper = _members(_KINDS["upper"])
    two = ends - starts > 1
    out["upper_words"] = count(owner[two][upper[data[starts[two] + 1]]]) / some if len(ends) else some * 0
    return np.column_stack([out[name] for name in NAMES])


@dataclass
class AdditiveModel:
    """Lookup tables: ``edges`` and ``tables`` by feature, ``pairs`` as (i, j, edges, table)."""
    intercept: float = 0.0
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for k, (edges, values) in enumerate(zip(self.edges, self.tables)):
            out += values[np.searchsorted(edges, x[:, k], "right")]
        for i, j, (left, right), values in self.pairs:
            out += values[np.searchsorted(left, x[:, i], "right"), np.searchsorted(right, x[:, j], "right")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def _gain(g, h):
    return g * g / (h + 1.0)


def _cut(g: np.ndarray, h: np.ndarray):
    """Best gain and place of one cut of a histogram."""
    if len(g) < 2:
        return 0.0, 0
    left, weight = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left, weight) + _gain(g.sum() - left, h.sum() - weight) - _gain(g.sum(), h.sum())
    place = int(np.argmax(gains))
    return float(gains[place]), place + 1


def _shallow_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Values by bin of the best tree of up to three leaves."""
    _, first = _cut(g, h)
    gains = [_cut(g[:first], h[:first]), _cut(g[first:], h[first:])]
    second = gains[0][1] if gains[0][0] >= gains[1][0] else first + gains[1][1]
    out = np.zeros(len(g))
    for part in np.split(np.arange(len(g)), sorted({first, second} - {0, len(g)})):
        out[part] = -g[part].sum() / (h[part].sum() + 1.0)
    return out


def _square_tree(g: np.ndarray, h: np.ndarray):
    """Gain and values of the best tree of one cut on each axis of a two-way histogram."""
    gs, hs = (np.pad(a.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for a in (g, h))
    a, b = (x[1:-1, 1:-1] for x in (gs, hs))
    up, left = (gs[1:-1, -1:], hs[1:-1, -1:]), (gs[-1:, 1:-1], hs[-1:, 1:-1])
    total = (gs[-1, -1], hs[-1, -1])
    quarters = [(a, b), (up[0] - a, up[1] - b), (left[0] - a, left[1] - b),
                (total[0] - up[0] - left[0] + a, total[1] - up[1] - left[1] + b)]
    gains = sum(_gain(*q) for q in quarters)
    i, j = np.unravel_index(int(np.argmax(gains)), gains.shape)
    out = np.empty(g.shape)
    for (rows, columns), (x, y) in zip(((slice(0, i + 1), slice(0, j + 1)), (slice(0, i + 1), slice(j + 1, None)),
                                        (slice(i + 1, None), slice(0, j + 1)), (slice(i + 1, None), slice(j + 1, None))), quarters):
        out[rows, columns] = -x[i, j] / (y[i, j] + 1.0)
    return float(gains[i, j] - _gain(*total)), out


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 200, pair_rounds: int = 100, pairs: int = 8,
        bins: int = 64, pair_bins: int = 12, rate: float = 0.1) -> AdditiveModel:
    """Cyclic boosting of the log loss. Without rows the model scores 0.5."""
    share = (y.sum() + 0.5) / (len(y) + 1.0)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    model.edges = [_edges(column, bins) for column in x.T]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(e, column, "right") for e, column in zip(model.edges, x.T)]
    margin = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(rounds):
        for values, at in zip(model.tables, binned):
            g, h = (np.bincount(at, s, len(values)) for s in slopes())
            step = rate * _shallow_tree(g, h)
            values += step
            margin += step[at]
    coarse = [_edges(column, pair_bins) for column in x.T]
    at = [np.searchsorted(e, column, "right") for e, column in zip(coarse, x.T)]

    def both(i, j):
        shape = len(coarse[i]) + 1, len(coarse[j]) + 1
        return shape, at[i] * shape[1] + at[j]

    ranked = []
    slope = slopes()
    for i in range(len(coarse)):
        for j in range(i + 1, len(coarse)):
            shape, cell = both(i, j)
            if min(shape) > 1:
                ranked.append((_square_tree(*(np.bincount(cell, s, shape[0] * shape[1]).reshape(shape) for s in slope))[0], i, j))
    chosen = sorted(ranked, reverse=True)[:pairs]
    model.pairs = [(i, j, (coarse[i], coarse[j]), np.zeros(both(i, j)[0])) for _, i, j in chosen]
    for _ in range(pair_rounds):
        for i, j, _, values in model.pairs:
            shape, cell = both(i, j)
            step = rate * _square_tree(*(np.bincount(cell, s, values.size).reshape(shape) for s in slopes()))[1]
            values += step
            margin += step.ravel()[cell]
    return model


def remainder(modulus: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % modulus


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, max_rows: int) -> DataFrame:
    """text and label (0.0 or 1.0) of at most ``max_rows`` labelled rows, those of least hash."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & keep)
    some = known.select("doc_id", F.col(label).cast("double").alias("label")).orderBy(
        F.xxhash64("doc_id"), "doc_id", "label").limit(max_rows)
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id").select("text", "label")


def train(docs: DataFrame, labels: DataFrame, keep: Column, max_rows: int = 20_000, **options) -> AdditiveModel:
    """Fit on the labels that satisfy ``keep``; at most ``max_rows`` rows of numbers reach the driver."""
    rows = labelled_sample(docs, labels, "quality", keep, max_rows)

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                x = features(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c) for c in np.ascontiguousarray(x.T)), part.column("label")], names=[*NAMES, "label"])

    found = shipped(rows).mapInArrow(run, ", ".join(f"{n} double" for n in [*NAMES, "label"])).toArrow()
    x = np.column_stack([found.column(n).to_numpy() for n in [*NAMES, "label"]])
    x = x[np.lexsort(x.T)]  # the same model whatever the order of arrival
    return fit(x[:, :-1], x[:, -1], **options)


def score(docs: DataFrame, model: AdditiveModel) -> DataFrame:
    """``docs`` with score, the probability of label 1."""
    docs, schema = with_fields(docs, "score double")
    as_text = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                scores = model.score(features(part.column("text")))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=schema.names)

    return shipped(as_text).mapInArrow(run, schema)


def trained(spark, sf_dir) -> AdditiveModel:
    return train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), remainder(3) != 1)


@query("op8_quality")
def op8_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, trained(spark, sf_dir))
    return scored.select("doc_id", (remainder(3) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
