"""Connected components by alternating large-star and small-star rounds over an edge table."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import cut


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b long): root is the component's least node.

    Each round is joins and combining aggregations over edges, checkpointed in the shared folder;
    only a count and a checksum reach the driver. Loops and repeated edges don't matter; without
    edges the result is empty.
    """
    edges = cut(edges.filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a")).toDF("u", "v")
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = cut(small.union(low.toDF("a", "b")).distinct())
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.toDF("node", "root").union(roots)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (node, least node of its component) that connect what the given edges connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], low)
        np.minimum.at(new, root[right], low)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]
