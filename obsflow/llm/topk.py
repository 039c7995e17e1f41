"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are dealt over blocks by hash. A block holds, per dimension, its rows sorted by component.
For a query the lists are read from the end that its component's sign prefers, deeper in every
round; rows met for the first time are scored in full, and reading stops as soon as the best score
that a row not met can have, the inner product with the components reached, is below the kth
score. An equal bound goes on, for a row not met could have the smaller id.

Blocks of queries travel to every block of candidates and stream past it, so a task holds one block
of each at a time; the best k of each query and block are merged at the end.

Defined results: a vector that is null or holds a null, NaN or infinite component takes no part,
nor does a row without id; a candidate of another length than the query is no candidate of it; rows
with the query's id are its own and are left out; of repeated query ids the least vector is used;
candidates that repeat are listed as often; ties go to the smaller id. Components are multiplied as
64-bit integers. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsflow.llm.common import cut, partitions, shipped, table
from obsflow.llm.registry import query

K, EVERY, BLOCK, QUERIES, FIRST_DEPTH = 5, 50, 8192, 1024, 32


def quantised(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and v, floor(256 x) of every component, of the rows that take part."""
    whole = F.col(column).isNotNull() & ~F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.filter(whole & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(column, lambda x: F.floor(x.cast("double") * 256)).alias("v"))


class Block:
    """Candidates of one length with their sorted lists."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.lists = np.argsort(self.rows, axis=0, kind="stable")
        self.reach = int(np.abs(self.rows).max(initial=0)) * max(1, rows.shape[1])
        self.real = self.rows.astype(float)

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        if self.reach * int(np.abs(q).max(initial=0)) < 1 << 53:  # sums of doubles are exact
            return (self.real[at] @ q.astype(float)).astype(np.int64)
        return self.rows[at] @ q

    def best(self, query: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best k rows."""
        n = len(self.ids)
        dims = np.flatnonzero(q)
        met = self.ids == query  # its own rows are never scored
        at = np.zeros(0, np.int64)
        scores = np.zeros(0, np.int64)
        down = q[dims] > 0
        depth, begin = FIRST_DEPTH, 0
        while True:
            end = min(depth, n)
            if len(dims):
                reached = np.concatenate([
                    self.lists[n - end : n - begin, dims[down]].ravel(), self.lists[begin:end, dims[~down]].ravel()])
            else:
                reached, end = np.arange(n), n
            new = np.zeros(n, bool)
            new[reached] = True
            new &= ~met
            met |= new
            fresh = np.flatnonzero(new)
            at, scores = np.concatenate([at, fresh]), np.concatenate([scores, self.scores(fresh, q)])
            order = np.lexsort((self.ids[at], -scores))[:k]
            at, scores = at[order], scores[order]
            if end == n:
                break
            edge = np.where(down, self.rows[self.lists[n - end, dims], dims], self.rows[self.lists[end - 1, dims], dims])
            if len(at) == k and scores[-1] > int(edge @ q[dims]):
                break
            begin, depth = end, 2 * depth
        return self.ids[at], scores


def _pack(batches):
    """Rows sorted by (block, size) to one row of bytes for each run of up to ``QUERIES`` rows."""
    key, ids, rows = None, [], []

    def packed():
        return pa.RecordBatch.from_pydict({
            "block": pa.array([key[0]], pa.int32()), "size": pa.array([key[1]], pa.int32()),
            "ids": [np.array(ids, "<i8").tobytes()], "rows": [np.array(rows, "<i8").tobytes()]})

    for batch in batches:
        for block, size, number, v in zip(*(batch.column(c).to_pylist() for c in ("block", "size", "vec_id", "v"))):
            if key is not None and ((block, size) != key or len(ids) == QUERIES):
                yield packed()
                ids, rows = [], []
            key = (block, size)
            ids.append(number)
            rows.append(v)
    if ids:
        yield packed()


def _search(k: int):
    def run(batches):
        block, found, built = None, {}, {}
        for batch in batches:
            out = []
            for row in zip(*(batch.column(c).to_pylist() for c in ("block", "is_query", "size", "ids", "rows"))):
                if row[0] != block:
                    block, found, built = row[0], {}, {}
                ids = np.frombuffer(row[3], "<i8")
                rows = np.frombuffer(row[4], "<i8").reshape(len(ids), row[2])
                if not row[1]:
                    found.setdefault(row[2], []).append((ids, rows))
                    continue
                if row[2] in found:
                    parts = found.pop(row[2])
                    built[row[2]] = Block(*(np.concatenate(x) for x in zip(*parts)))
                if row[2] in built:
                    for number, q in zip(ids.tolist(), rows):
                        best, scores = built[row[2]].best(number, q, k)
                        out.append((np.full(len(best), number), best, scores))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)],
                                                 names=["query_id", "vec_id", "score"])
    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id and score; ``vectors`` has vec_id and v (array<long>)."""
    spark = vectors.sparkSession
    rows = cut(vectors)
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))

    def packed(df: DataFrame, size: int) -> tuple[DataFrame, int]:
        blocks = max(1, -(-df.count() // size))
        dealt = df.select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"),
                          F.size("v").alias("size"), "vec_id", "v")
        dealt = dealt.repartition(partitions(spark), "block").sortWithinPartitions("block", "size")
        return shipped(dealt).mapInArrow(_pack, "block int, size int, ids binary, rows binary"), blocks

    candidates, blocks = packed(rows, BLOCK)
    sent, _ = packed(queries, QUERIES)
    copies = cut(sent).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = candidates.withColumn("is_query", F.lit(False)).unionByName(copies.withColumn("is_query", F.lit(True)))
    met = both.repartition(partitions(spark), "block").sortWithinPartitions("block", "is_query")
    found = shipped(met).mapInArrow(_search(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


SQL = f"""
with e as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as (
  select q.vec_id as query_id, c.vec_id,
         list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from e q, e c where q.vec_id % {EVERY} = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from p)
select query_id, rank, vec_id, score from r where rank <= {K}
"""


@query("op9_fagin", SQL)
def op9_fagin(spark, sf_dir):
    return top_k(quantised(table(spark, sf_dir, "embeddings")), F.col("vec_id") % EVERY == 0)
