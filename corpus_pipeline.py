"""A corpus from raw documents: five of the training-data operators one after the other.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a frame
that is written as Parquet and read again as the docs of the next one. All but the last return the
columns of documents. A stage handles null and empty texts, repeated rows and empty tables as its
operator says.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from obsflow.llm import mixing, quality, sentencepiece, simhash, substring
from obsflow.llm.common import table, written


def keep_quality(spark, docs, sf_dir):
    """Documents that the quality classifier, trained on the labels, does not reject."""
    model = quality.train(docs, table(spark, sf_dir, "labels"), quality.remainder(3) != 1)
    scored = quality.score(docs.select("*", F.struct("*").alias("_doc")), model)
    return scored.filter("score >= 0.5").select("_doc.*")


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each group of texts whose fingerprints over three-word shingles are linked at
    two or fewer differing bits, as in op5: the one of least id."""
    return simhash.one_of_each(docs)


def drop_repeated_passages(spark, docs, sf_dir):
    """Texts without the pieces of passages that an earlier document has; n_chars follows."""
    rest = F.struct(*(c for c in docs.columns if c != "text"))  # a text is shuffled once
    cut = substring.without_repeats(docs.select("doc_id", "text", rest.alias("_doc")))
    size = F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("_doc.n_chars"))
    made = {"text": F.col("text"), "n_chars": size}
    return cut.select(*(made.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns))


def mix_sources(spark, docs, sf_dir):
    """Documents of all sources in their target amounts, repeated where a source is short."""
    return mixing.mixed_documents(docs)


def encode(spark, docs, sf_dir):
    """The documents with token_ids, n_tokens, ids_crc32 and exact; texts that don't come back
    from their ids keep exact false."""
    coded = sentencepiece.round_trip(docs.withColumn("_text", F.col("text")))
    return coded.withColumnRenamed("_text", "text").select(
        *docs.columns, "token_ids", "n_tokens", "ids_crc32", "exact")


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("mix_sources", mix_sources),
    ("sentencepiece", encode),
]

#: Hashes, fitted scores and Viterbi paths are beyond SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
