"""SimHash near-duplicates by anchor-point covering.

The anchors are the codewords of the binary Golay code on two blocks of 23 of the 64 bits. The
code is perfect: every block value lies within 3 bits of exactly one codeword, so the pair of
nearest codewords is a fingerprint's home. Fingerprints are copied to every anchor within 3 bits a
block plus the threshold, shared by the two blocks; at each anchor the fingerprints at home are
compared with all others. Of two fingerprints within the threshold each one reaches the other's
home, so no link is lost.

Equal texts share a fingerprint and are one row before the search. At an anchor with many
fingerprints at home these are dealt over several tiles and the others are copied to each tile, so
that no task holds more than ``TILE`` of them at a time; the rest streams past. Tasks give the
links of a batch as a spanning forest, never as all pairs of a group.

Defined results: a null text is empty; texts without words have fingerprint 0, which links like
any other; rows that repeat get the same result; ``component_id`` skips null ids; an empty table
gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import IS_SPACE, chosen, cut, partitions, shipped, slices, table, text_bytes, words_of
from obsflow.llm.components import connected_components, forest
from obsflow.llm.registry import query

SHINGLE, SEED, DISTANCE, TILE = 3, 42, 2, 2048
#: Up to so many anchors with tiles, one row each, the list is sent to every task; else joined.
MAX_LIST = 10_000
_GENERATOR, _BLOCK, _RADIUS = 0xC75, 23, 3


def _shingles(data: np.ndarray, offsets: np.ndarray, size: int):
    """Bytes with one space between words, and start, end and text of each shingle in them."""
    starts, ends, owner = words_of(data, offsets)
    keep = ~IS_SPACE[data]
    inner = starts > offsets[owner]
    keep[starts[inner] - 1] = True
    plain = data.copy()
    plain[IS_SPACE[plain]] = 32
    place = np.concatenate([[0], np.cumsum(keep)])
    starts, ends = place[starts], place[ends - 1] + 1
    counts = np.bincount(owner, minlength=len(offsets) - 1)
    first = (np.cumsum(counts) - counts)[owner]
    index = np.arange(len(starts))
    last = np.minimum(index + size, first + counts[owner]) - 1
    use = (last - index == size - 1) | ((index == first) & (counts[owner] < size))
    return plain[keep].tobytes(), starts[use], ends[last[use]], owner[use]


def simhash(texts: pa.Array, size: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """Fingerprints of a batch as signed 64-bit numbers."""
    data, offsets = text_bytes(texts)
    upper = (data >= 65) & (data <= 90)
    plain, starts, ends, owner = _shingles(data + 32 * upper.astype(np.uint8), offsets, size)
    out = np.zeros(len(texts), np.int64)
    if len(starts):
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(plain[s:e], seed) for s, e in zip(starts.tolist(), ends.tolist())], np.uint64)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        ones = np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
        total = np.diff(np.r_[heads, len(owner)])[:, None]
        out[owner[heads]] = np.packbits(2 * ones > total, axis=1, bitorder="little").view("<i8").ravel()
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """doc_id, row_hash (of all columns) and fp of every row."""
    rows = docs.select("doc_id", F.xxhash64(*sorted(docs.columns)).alias("row_hash"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 2 << 20):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_hash"), pa.array(simhash(part.column("text"), size, seed))],
                    names=["doc_id", "row_hash", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return shipped(rows).mapInArrow(run, f"doc_id {kind}, row_hash long, fp long")


@cache
def _golay(reach: int = _RADIUS + DISTANCE):
    """Syndromes of the 11 low and 12 high bits of a block; all error patterns of up to ``reach``
    bits by syndrome and weight; where those of each syndrome and weight begin."""
    def remainder(word: int) -> int:
        for bit in range(_BLOCK - 1, 10, -1):
            if word >> bit & 1:
                word ^= _GENERATOR << (bit - 11)
        return word

    single = [remainder(1 << bit) for bit in range(_BLOCK)]
    high = np.zeros(1 << 12, np.int64)
    for bit in range(12):
        high[(np.arange(1 << 12) >> bit & 1) == 1] ^= single[bit + 11]
    found = []
    for weight in range(reach + 1):
        for bits in combinations(range(_BLOCK), weight):
            pattern = syndrome = 0
            for bit in bits:
                pattern |= 1 << bit
                syndrome ^= single[bit]
            found.append((syndrome, max(0, weight - _RADIUS), pattern))
    found = np.array(sorted(found), np.int64)
    begin = np.searchsorted(found[:, 0] * 8 + found[:, 1], np.arange(1 << 11)[:, None] * 8 + np.arange(reach - _RADIUS + 2))
    return high, found[:, 2], begin


def anchors_of(fps: np.ndarray, distance: int = DISTANCE):
    """Index into ``fps``, anchor, and whether it is the home, for all anchors in reach."""
    high, patterns, begin = _golay(_RADIUS + distance)
    word = fps.view(np.uint64)
    blocks = [((word >> np.uint64(s)) & np.uint64((1 << _BLOCK) - 1)).astype(np.int64) for s in (0, _BLOCK)]
    syndromes = [high[b >> 11] ^ (b & 2047) for b in blocks]
    index, anchors, home = [], [], []
    for extra in range(distance + 1):  # bits beyond the radius in the first block
        low = [begin[syndromes[0], extra], begin[syndromes[1], 0]]
        n = [begin[syndromes[0], extra + 1] - low[0], begin[syndromes[1], distance - extra + 1] - low[1]]
        each = np.repeat(np.arange(len(fps)), n[0] * n[1])
        k = np.arange(len(each)) - np.repeat(np.cumsum(n[0] * n[1]) - n[0] * n[1], n[0] * n[1])
        first = blocks[0][each] ^ patterns[low[0][each] + k // n[1][each]]
        second = blocks[1][each] ^ patterns[low[1][each] + k % n[1][each]]
        index.append(each)
        anchors.append((first >> 11) << 12 | second >> 11)
        home.append((k == 0) if extra == 0 else np.zeros(len(k), bool))
    return np.concatenate(index), np.concatenate(anchors).astype(np.int32), np.concatenate(home)


def _replicate(batches):
    for batch in batches:
        fps = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
        for start in range(0, len(fps), 4096):
            part = fps[start : start + 4096]
            index, anchors, home = anchors_of(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors), pa.array(part[index]), pa.array(home)], names=["anchor", "fp", "home"])


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= DISTANCE


def links_at_anchors(keys: np.ndarray, fps: np.ndarray, home: np.ndarray):
    """Links between fingerprints at home and all others of the same key, as a forest.

    Rows are sorted by key, those at home first.
    """
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    sizes = np.diff(np.r_[heads, len(keys)])
    use = np.repeat(home[heads] & (sizes > 1) & (sizes <= 32), sizes)
    at = np.flatnonzero(use)
    left, right = [], []
    k, f, h = keys[at], fps[at], home[at]
    for step in range(1, int(sizes[sizes <= 32].max(initial=1))):
        hit = (k[step:] == k[:-step]) & h[:-step]
        hit = np.flatnonzero(hit)
        hit = hit[_near(f[hit], f[hit + step])]
        left.append(f[hit])
        right.append(f[hit + step])
    for start, size in zip(heads[sizes > 32].tolist(), sizes[sizes > 32].tolist()):
        homes = fps[start : start + int(home[start : start + size].sum())]
        for begin in range(start, start + size if len(homes) else start, 1024):
            some = fps[begin : min(begin + 1024, start + size)]
            i, j = np.nonzero(_near(homes[:, None], some[None, :]) & (homes[:, None] != some[None, :]))
            a, b = forest(homes[i], some[j])
            left.append(a)
            right.append(b)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return forest(np.concatenate(left), np.concatenate(right))


def _compare(batches):
    """Streams rows sorted by (anchor, tile), those at home first; keeps the last key's homes."""
    kept = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
    for batch in batches:
        if not batch.num_rows:
            continue
        column = lambda name: batch.column(name).to_numpy(zero_copy_only=False)
        rows = [column("anchor").astype(np.int64) << 32 | column("tile").astype(np.int64), column("fp"), column("home")]
        keys, fps, home = (np.concatenate(pair) for pair in zip(kept, rows))
        a, b = links_at_anchors(keys, fps, home)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        last = (keys == keys[-1]) & home
        kept = [keys[last], fps[last], home[last]]


def links(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) that connect all fingerprints (fp) within ``DISTANCE`` bits of each other."""
    spark = distinct.sparkSession
    # The table is small before it is copied and would be left to a few tasks.
    # By a hash of the key, as a repartition by the key itself would be taken for done.
    spread = distinct.select("fp").repartition(partitions(spark), F.xxhash64("fp"))
    copies = shipped(spread).mapInArrow(_replicate, "anchor int, fp long, home boolean")
    full = cut(copies.filter("home").groupBy("anchor").count().filter(F.col("count") > TILE)
               .select("anchor", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")))
    if full.count() <= MAX_LIST:
        full = F.broadcast(full)
    tiled = copies.join(full, "anchor", "left").withColumn(
        "tile", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("tiles"), F.lit(1)) - 1)))
    own = F.pmod(F.xxhash64("fp"), F.coalesce(F.col("tiles"), F.lit(1))) == F.col("tile")
    rows = tiled.select("anchor", "tile", "fp", (F.col("home") & own).alias("home"))
    dealt = rows.repartition(partitions(spark), "anchor", "tile").sortWithinPartitions(
        "anchor", "tile", F.desc("home"))
    return shipped(dealt).mapInArrow(_compare, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, fp and component_id (least doc_id reachable) of every row."""
    rows = cut(fingerprints(docs))
    groups = rows.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(groups))
    linked = groups.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    component = linked.join(least, "root").select("fp", "root", "component_id")
    return rows.join(component, "fp").select("doc_id", "row_hash", "fp", "root", "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: the one of least id of each component stays.

    Of several rows with that id the one of least row hash stays.
    """
    found = near_duplicates(docs).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stay = found.groupBy("root", "doc_id").agg(F.min("row_hash").alias("_hash")).select(
        F.col("doc_id").alias("_id"), "_hash")
    return chosen(docs, stay)


@query("op5_simhash")
def op5_simhash(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
