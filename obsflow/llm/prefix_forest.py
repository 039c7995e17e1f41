"""Approximate nearest neighbours by a forest of hash prefixes.

A tree hashes every vector to a string of ``BITS`` bits, the sides of as many random directions it
lies on, and keeps the strings as one sorted array, so that all vectors that share a prefix stand
together. A query descends in every tree to the longest prefix that it shares with anything, and
then ascends in all trees at once, a bit at a time, taking in the wider ranges, until the ranges
hold enough rows; on the last level the trees are widened one after the other. As ranges only grow
on the way up, the level is found by bisection. All rows met are scored exactly.

Nearness is the inner product: vectors are scaled to the longest one of their block and get one
component more that fills their length up to 1, so angles to a query order them by inner product.
The directions of a tree are orthogonal, which hashes more evenly than independent ones.

Rows are dealt over blocks of about ``BLOCK``, each with its own forest, and queries over groups of
about ``QUERIES``; a task has one block and one group at a time, and the best of all blocks are
merged. A range counts with its repeats: ``LEAST`` rows and ``SHARE`` of the block are asked for.
Vectors without any structure need such a share (README has the measured recall); where vectors lie
in clusters the longest prefixes hold the neighbours.

Defined results: a vector that is null, all zero or empty, or holds a null, NaN or infinite
component takes no part, nor does a row without id; a row of another length than the query is no
candidate of it, nor is one of its id; of repeated query ids the least vector is used; candidates
that repeat are listed as often. Equal vectors have equal scores, ties go to the smaller id. An
empty table gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import cut, partitions, shipped, table
from obsflow.llm.packs import pack, packed_schema, tops, whole
from obsflow.llm.registry import query

K, EVERY, BLOCK, QUERIES = 20, 20, 8192, 8192
TREES, BITS, LEAST, SHARE = 128, 64, 2048, 0.45
_KINDS = {"ids": "<i8", "v": "<f8"}


def taking_part(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and v (array<double>) of the rows that take part."""
    use = whole(column) & F.exists(column, lambda x: x != 0) & F.col("vec_id").isNotNull()
    return vectors.filter(use).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))


@cache
def directions(size: int) -> np.ndarray:
    """The directions of all trees, ``TREES`` x ``size`` x ``BITS``."""
    random = np.random.default_rng(size)
    turns = -(-BITS // size)
    return np.stack([np.hstack([np.linalg.qr(random.normal(size=(size, size)))[0] for _ in range(turns)])[:, :BITS]
                     for _ in range(TREES)])


def strings(vectors: np.ndarray) -> np.ndarray:
    """The hash string of every vector in every tree, as numbers whose first bit is the highest."""
    return np.stack([np.packbits(vectors @ tree > 0, axis=1).view(">u8").ravel().astype(np.uint64)
                     for tree in directions(vectors.shape[1])])


class Forest:
    """Sorted arrays over the rows of a block, all of one length."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.reach = np.sqrt((self.rows**2).sum(axis=1).max())
        scaled = self.rows / self.reach
        rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
        keys = strings(np.column_stack([scaled, rest]))
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, axis=1)

    def ranges(self, keys: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the rows that share the first ``level`` bits, by tree and query."""
        rest = np.where(level > 0, np.uint64((1 << 64) - 1) >> np.minimum(level, 63).astype(np.uint64), np.uint64((1 << 64) - 1))
        rest = np.where(level >= BITS, np.uint64(0), rest)
        low, high = keys & ~rest, keys | rest
        return (np.stack([np.searchsorted(k, x, "left") for k, x in zip(self.keys, low)]),
                np.stack([np.searchsorted(k, x, "right") for k, x in zip(self.keys, high)]))

    def met(self, queries: np.ndarray, least: float, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the rows that each query meets in each tree."""
        norms = np.sqrt((queries**2).sum(axis=1))[:, None]
        keys = strings(np.column_stack([queries / norms, np.zeros(len(queries))]))
        enough = least + share * len(self.ids)
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), BITS)
        while (low < high).any():  # the longest prefix that is shared often enough
            middle = (low + high + 1) // 2
            begin, end = self.ranges(keys, middle)
            good = (end - begin).sum(axis=0) >= enough
            low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
        begin, end = self.ranges(keys, low)
        below = self.ranges(keys, np.minimum(low + 1, BITS))
        n, more = below[1] - below[0], (end - begin) - (below[1] - below[0])
        # Trees are widened to the last level one by one, until that is enough.
        before = n.sum(axis=0) + np.cumsum(more, axis=0) - more
        wide = before < enough
        return np.where(wide, begin, below[0]), np.where(wide, end, below[1])

    def nearest(self, numbers: np.ndarray, queries: np.ndarray, k: int, least: float = LEAST, share: float = SHARE):
        """Index of the query, id and score of the best ``k`` rows met by each."""
        begins, ends = self.met(queries, least, share)
        base = np.arange(TREES) * len(self.ids)
        order = self.order.ravel()
        out = []
        for i, (number, q) in enumerate(zip(numbers, queries)):
            n = ends[:, i] - begins[:, i]
            at = np.arange(n.sum()) + np.repeat(base + begins[:, i] - (np.cumsum(n) - n), n)
            use = np.zeros(len(self.ids), bool)
            use[order[at]] = True
            use[np.searchsorted(self.ids, number, "left") : np.searchsorted(self.ids, number, "right")] = False
            found = np.flatnonzero(use)
            if len(found) > k:  # sums in any order first; those that may be among the best in one order
                rough = self.rows[found] @ q
                slack = 1e-12 * self.reach * np.sqrt(q @ q)
                found = found[rough >= np.partition(rough, len(rough) - k)[len(rough) - k] - slack]
            scores = (self.rows[found] * q).sum(axis=1)
            best = np.lexsort((self.ids[found], -scores))[:k]
            out.append((np.full(len(best), number), self.ids[found[best]], scores[best]))
        return [np.concatenate(x) for x in zip(*out)]


def _search(k: int, least: float, share: float):
    def run(batches):
        key, parts, forest = None, {}, {}
        for batch in batches:
            for block, group, is_query, size, n, ids, v in zip(*(batch.column(c).to_pylist() for c in (
                    "block", "group", "is_query", "size", "n", "ids", "v"))):
                if (block, group) != key:
                    key, parts, forest = (block, group), {}, {}
                rows = np.frombuffer(ids, _KINDS["ids"]), np.frombuffer(v, _KINDS["v"]).reshape(n, size)
                if not is_query:
                    parts.setdefault(size, []).append(rows)
                    continue
                if size in parts:
                    forest[size] = Forest(*map(np.concatenate, zip(*parts.pop(size))))
                if size in forest:
                    found = forest[size].nearest(*rows, k, least, share)
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, found)), names=["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, is_query: Column, k: int = K, least: float = LEAST, share: float = SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` nearest found of each query;
    ``vectors`` has vec_id and v (array<double>). ``least`` rows and a ``share`` of each block are met."""
    spark = vectors.sparkSession
    rows = cut(vectors)
    queries = cut(rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")))
    blocks, groups = (max(1, -(-df.count() // most)) for df, most in ((rows, BLOCK), (queries, QUERIES)))

    def packs(df, into, n, most, other, m):
        """The rows dealt over ``n`` blocks or groups, as packs repeated for all ``m`` of the others."""
        # Places in a checkpoint stay, so rows that repeat are dealt evenly too.
        spot = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int").alias(into)
        dealt = df.select(spot, F.col("vec_id").alias("ids"), "v", F.size("v").alias("size")).repartition(
            partitions(spark), into).sortWithinPartitions(into, "size")
        made = shipped(dealt).mapInArrow(pack(_KINDS, most, (into, "size")), packed_schema(_KINDS, (into, "size")))
        return cut(made.drop("part", "seq")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1))))

    both = packs(rows, "block", blocks, 1024, "group", groups).withColumn("is_query", F.lit(False)).unionByName(
        packs(queries, "group", groups, 1024, "block", blocks).withColumn("is_query", F.lit(True)))
    met = both.repartition(partitions(spark), "block", "group").sortWithinPartitions("block", "group", "is_query")
    found = shipped(met).mapInArrow(_search(k, least, share), "query_id long, vec_id long, score double")
    return tops(found, ["query_id"], k).select("query_id", "rank", "vec_id", "score")


@query("op11_prefix_forest")
def op11_prefix_forest(spark, sf_dir):
    return nearest(taking_part(table(spark, sf_dir, "embeddings")), F.col("vec_id") % EVERY == 0)
