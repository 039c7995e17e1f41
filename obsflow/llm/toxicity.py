"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over the words of a text and their first four and five bytes learns from
confirmed toxic texts and from unlabelled ones. With the share ``prior`` of toxic texts, the risk
is prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)]), l the logistic loss; where the
second term falls below zero its gradient is followed upwards, which keeps it from overfitting.

Which words take part is decided by document frequencies counted in Spark; the fit itself is numpy
on the driver, on at most ``positives`` toxic and ``unlabelled`` other texts, those of least hash,
each as a list of at most ``width`` feature numbers. The prior is the share of toxic labels over
all labels that may be learnt from.

Defined results: null and empty texts score like a text without words; labels without a document,
or null, teach nothing; without a toxic example every score is 0. Rows that repeat get the same
score; an empty table gives an empty result; a null id counts as the empty text. Other columns
don't matter.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import shipped, slices, span_hashes, table, text_bytes, with_fields, words_of
from obsflow.llm.quality import remainder
from obsflow.llm.registry import query

POSITIVES, UNLABELLED, WIDTH = 5_000, 10_000, 4096
#: A feature takes part if its frequencies differ by so many standard errors.
SURE = 5.0
_PREFIXES = (4, 5)
_BETWEEN = np.ones(256, bool)
_BETWEEN[97:123] = _BETWEEN[128:] = False


def word_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all words of a batch and their texts, repeats included.

    A word is a run of letters (A-Z lower-cased) or bytes beyond ASCII.
    """
    data, offsets = text_bytes(texts)
    data = data + 32 * ((data >= 65) & (data <= 90)).astype(np.uint8)
    starts, ends, owner = words_of(data, offsets, _BETWEEN)
    found, whose = [span_hashes(data, starts, ends)], [owner]
    for k in _PREFIXES:
        longer = ends - starts > k
        found.append(span_hashes(data, starts[longer], starts[longer] + k) ^ np.uint64(k))
        whose.append(owner[longer])
    return np.concatenate(found), np.concatenate(whose)


@dataclass
class Classifier:
    """Sorted feature hashes, their weights and the bias; None for the constant 0."""
    hashes: np.ndarray
    weights: np.ndarray
    bias: float | None

    def __post_init__(self):
        self.maybe = np.zeros(1 << 20, bool)  # most words are ruled out by one lookup
        self.maybe[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def present(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text and feature number of every feature that occurs, once each, by text."""
        hashes, owner = word_features(texts)
        some = self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)]
        hashes, owner = hashes[some], owner[some]
        at = np.minimum(np.searchsorted(self.hashes, hashes), max(len(self.hashes) - 1, 0))
        hit = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        pairs = np.unique(owner[hit] * np.int64(len(self.hashes) + 1) + at[hit])
        return pairs // (len(self.hashes) + 1), pairs % (len(self.hashes) + 1)

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.bias is None:
            return np.zeros(len(texts))
        text, feature = self.present(texts)
        margin = self.bias + np.bincount(text, self.weights[feature], len(texts))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def fit(lists: list[np.ndarray], positive: np.ndarray, width: int, prior: float, steps: int = 300,
        rate: float = 0.05, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk, by Adam over all rows at once.

    ``lists`` has the features of each text, ``positive`` marks the toxic examples.
    """
    rows = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    features = np.concatenate([np.zeros(0, np.int64), *lists]).astype(np.int64)
    theta = np.zeros(width + 1)
    theta[width] = np.log(prior / (1 - prior))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    unlabelled = ~positive
    n_p, n_u = max(1, positive.sum()), max(1, unlabelled.sum())
    for step in range(1, steps + 1):
        f = theta[width] + np.bincount(rows, theta[features], len(lists))
        p = 1 / (1 + np.exp(-np.clip(f, -30, 30)))
        negative_loss = np.logaddexp(0, f)
        rest = negative_loss[unlabelled].sum() / n_u - prior * negative_loss[positive].sum() / n_p
        of_rest = np.where(positive, -prior * p / n_p, p / n_u)
        slope = np.where(positive, prior * (p - 1) / n_p, 0) + of_rest if rest >= 0 else -of_rest
        g = np.append(np.bincount(features, slope[rows], width), slope.sum())
        g[:width] += decay * theta[:width] / width
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:width], float(theta[width])


def _frequencies(batches):
    for batch in batches:
        for part in slices(batch, "text", 2 << 20):
            hashes, owner = word_features(part.column("text"))
            toxic = part.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            once = np.ones(len(hashes), bool)
            once[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
            hashes, owner = hashes[once], owner[once]
            heads = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, int)
            both = [np.add.reduceat(x.astype(np.int64), heads) if len(heads) else np.zeros(0, np.int64)
                    for x in (toxic[owner], ~toxic[owner])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[heads].view(np.int64)), *map(pa.array, both)], names=["feature", "p", "u"])


def train(docs: DataFrame, labels: DataFrame, keep: Column, positives: int = POSITIVES,
          unlabelled: int = UNLABELLED, width: int = WIDTH, **options) -> Classifier:
    """Fit on toxic labels that satisfy ``keep`` and on texts, whatever their label, that do."""
    known = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & keep)
    n, toxic = known.agg(F.count("*"), F.count_if(F.col("toxic") == 1)).first()
    none = Classifier(np.zeros(0, np.uint64), np.zeros(0), None)
    if not toxic:
        return none
    # Both lists are bounded by parameters.
    some = known.filter("toxic = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(positives)
    other = docs.filter(keep).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(unlabelled)
    chosen = some.withColumn("toxic", F.lit(True)).union(other.withColumn("toxic", F.lit(False)))
    text = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = text.join(F.broadcast(chosen), "doc_id").select("text", "toxic").persist()
    sizes = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        rows.unpersist()
        return none
    counts = shipped(rows).mapInArrow(_frequencies, "feature long, p long, u long").groupBy("feature").agg(
        F.sum("p").alias("p"), F.sum("u").alias("u")).filter("p >= 3")
    share = (F.col("p") + F.col("u")) / (n_p + n_u)
    z = (F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(share * (1 - share) + 1e-9)
    z = z * float(np.sqrt(n_p * n_u / (n_p + n_u)))
    best = counts.select("feature", z.alias("z")).filter(F.col("z") >= SURE).orderBy(F.desc("z"), "feature").limit(width)
    hashes = np.sort(np.array([r.feature for r in best.collect()], np.int64).view(np.uint64))
    model = Classifier(hashes, np.zeros(len(hashes)), 0.0)

    def lists(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                owner, feature = model.present(part.column("text"))
                bounds = np.searchsorted(owner, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column("toxic"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(feature.astype(np.int32)))],
                    names=["toxic", "features"])

    found = sorted((r.toxic, r.features) for r in shipped(rows).mapInArrow(lists, "toxic boolean, features array<int>").collect())
    rows.unpersist()
    prior = min(max(toxic / n, 1e-3), 0.999)
    weights, bias = fit([np.array(f, np.int64) for _, f in found], np.array([t for t, _ in found]), len(hashes), prior, **options)
    return Classifier(hashes, weights, bias)


def score(docs: DataFrame, model: Classifier) -> DataFrame:
    """``docs`` with score, the probability of being toxic."""
    docs, schema = with_fields(docs, "score double")
    as_text = docs.withColumn("text", F.col("text").cast("string"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(model.score(part.column("text")))], names=schema.names)

    return shipped(as_text).mapInArrow(run, schema)


@query("op10_toxicity")
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), remainder(5) != 0)
    return score(docs, model).select("doc_id", (remainder(5) == 0).alias("held_out"), "score",
                                     (F.col("score") >= 0.5).cast("int").alias("predicted"))
