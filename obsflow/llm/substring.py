"""Substring dedup by sliding sentence spans.

Sentences are taken in pieces, as a repeated passage often begins and ends inside sentences: a
piece ends with a word that ends in one of ``.!?,;:``, at a line break, or with a word whose hash is
0 modulo ``EVERY``, which is the same word wherever the passage stands. A span is a run of several
consecutive pieces: at least ``SENTENCES`` pieces with ``SOME_WORDS`` words, or ``MANY_WORDS``
words. The shortest such run from every piece on and up to every piece is hashed. That has the
effect of hashing every run: a longer one that repeats is covered, from its first to its last
piece, by the shortest ones within it, which then repeat too. Spans are compared by their words,
whatever white space is between.

All spans are hashed and joined over the whole corpus; the first one of each hash (least doc_id,
then place in the text) stays, and every piece that any other one covers is removed.

Defined results: a null text stays null, an empty one empty; a text all of whose pieces go is
empty; texts that lose nothing stay as they are to the byte. Rows that share a doc_id are one
place: none of them is removed for another. Null ids come after all others and not before each
other. An empty table gives an empty result. Other columns are kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import (
    fresh, sequence_hashes, shipped, slices, span_hashes, table, text_bytes, with_fields, words_of,
)
from obsflow.llm.registry import query

SENTENCES, SOME_WORDS, MANY_WORDS, EVERY = 3, 35, 50, 12
_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?,;:")] = True


def sentence_spans(texts: pa.Array):
    """Pieces (start byte of each, its text) and spans (first and last sentence, hash) of a batch,
    spans in order of text, first and last sentence."""
    data, offsets = text_bytes(texts)
    starts, ends, owner = words_of(data, offsets)
    none = np.zeros(0, np.int64)
    if not len(starts):
        return data, offsets, (none, none), (none, none, np.zeros(0, np.uint64))
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    words = span_hashes(data, starts, ends)
    last = _ENDS[data[ends - 1]] | (words % np.uint64(EVERY) == 0)
    last[:-1] |= (owner[1:] != owner[:-1]) | (breaks[starts[1:]] > breaks[ends[:-1]])
    last[-1] = True
    stop = np.flatnonzero(last) + 1
    begin = np.concatenate([[0], stop[:-1]])
    text = owner[begin]
    heads = np.searchsorted(text, text, "left")
    tails = np.searchsorted(text, text, "right") - 1
    index = np.arange(len(begin))
    many = np.searchsorted(stop, begin + MANY_WORDS)
    some = np.maximum(np.searchsorted(stop, begin + SOME_WORDS), index + SENTENCES - 1)
    after = np.minimum(many, some)
    many = np.searchsorted(begin, stop - MANY_WORDS, "right") - 1
    some = np.minimum(np.searchsorted(begin, stop - SOME_WORDS, "right") - 1, index - SENTENCES + 1)
    before = np.maximum(many, some)
    pairs = np.concatenate([
        (index << 32 | after)[after <= tails], (before << 32 | index)[before >= heads]])
    pairs = np.unique(pairs)
    first, final = pairs >> 32, pairs & 0xFFFFFFFF
    hashes = sequence_hashes(words, begin[first], stop[final])
    return data, offsets, (starts[begin], text), (first, final, hashes)


def _firsts(text: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each span is the first with its hash in its text."""
    order = np.lexsort((np.arange(len(text)), hashes, text))
    new = np.ones(len(order), bool)
    new[1:] = (text[order][1:] != text[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    out = np.zeros(len(order), bool)
    out[order[new]] = True
    return out


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, place (number of the span in its text) and hash of every span, the first
    one of each hash in a text."""
    rows = docs.select("doc_id", F.xxhash64(*sorted(docs.columns)).alias("row_hash"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                _, _, (_, text), (first, _, hashes) = sentence_spans(part.column("text"))
                own = text[first]
                place = np.arange(len(own)) - np.searchsorted(own, own, "left")
                keep = np.flatnonzero(_firsts(own, hashes))
                at = pa.array(own[keep])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(at), part.column("row_hash").take(at),
                     pa.array(place[keep].astype(np.int32)), pa.array(hashes[keep].view(np.int64))],
                    names=["doc_id", "row_hash", "place", "hash"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return shipped(rows).mapInArrow(run, f"doc_id {kind}, row_hash long, place int, hash long")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash and places of the spans that another document has first."""
    found = spans(docs)
    first = found.groupBy("hash").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    later = found.join(first.drop("n"), "hash").filter(
        (F.col("doc_id") > F.col("first")) | (F.col("doc_id").isNull() & F.col("first").isNotNull()))
    # A set, as rows that repeat bring the same places: bounded by the pieces of the one text.
    return later.groupBy("doc_id", "row_hash").agg(F.collect_set("place").alias("places"))


def _cut_texts(texts: pa.Array, places: pa.Array):
    """The texts without the pieces of the spans at ``places`` and of spans that the same text has
    before; pieces and removed pieces of each."""
    data, offsets, (starts, text), (first, final, hashes) = sentence_spans(texts)
    own = text[first]
    drop = ~_firsts(own, hashes)
    begin = np.searchsorted(own, np.arange(len(texts)), "left")
    listed = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(texts)), np.nan_to_num(
        pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False)).astype(np.int64))
    drop[begin[rows] + listed] = True
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, first[drop], 1)
    np.add.at(cover, final[drop] + 1, -1)
    gone = np.cumsum(cover)[:-1] > 0
    total = np.bincount(text, minlength=len(texts))
    removed = np.bincount(text[gone], minlength=len(texts))
    # A piece reaches up to the next one; what stands before the first belongs to it.
    head = np.ones(len(starts), bool)
    head[1:] = text[1:] != text[:-1]
    start = np.where(head, offsets[text], starts)
    end = np.concatenate([start[1:], [len(data)]])[: len(starts)]
    end = np.minimum(end, offsets[text + 1]) if len(starts) else end
    mark = np.zeros(len(data) + 1, np.int64)
    np.add.at(mark, start[gone], 1)
    np.add.at(mark, end[gone], -1)
    stays = np.cumsum(mark)[:-1] == 0
    sizes = np.concatenate([[0], np.cumsum(stays)])[offsets]
    out = pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(data[stays].tobytes()))
    out = pc.if_else(pc.is_null(texts), pa.scalar(None, pa.large_string()), out)
    return out.cast(pa.string()), total, removed


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated pieces removed from ``text``, and their numbers: n_sentences, n_removed."""
    found = repeated_spans(docs)
    key, place = fresh(docs, "row_hash"), fresh(docs, "places")
    rows = docs.withColumn(key, F.xxhash64(*sorted(docs.columns)))
    lists = found.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), F.col("places").alias(place))
    same = rows["doc_id"].eqNullSafe(lists["_id"]) & (rows[key] == lists["_hash"])
    kept, schema = with_fields(docs, "n_sentences long, n_removed long")
    names = kept.columns
    joined = rows.join(lists, same, "left").select(*(rows[c] for c in names), lists[place])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                text, total, removed = _cut_texts(part.column("text"), part.column(place))
                columns = [text if name == "text" else part.column(name) for name in names]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(total), pa.array(removed)], names=schema.names)

    return shipped(joined).mapInArrow(run, schema)


@query("op3_sentence_spans")
def op3_sentence_spans(spark, sf_dir):
    """doc_id, the text that stays, n_sentences and n_removed of every document."""
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
