"""Document fingerprints by MinHash.

A text's shingles are its runs of five words. ``HASHES`` universal hash permutations
x -> a x + b modulo 2^32 with odd a run over all shingles in numpy, and the least value of each
makes the signature. The printed fingerprint has the low byte of each (b-bit minwise hashing); the
likeness of two is the share of equal bytes less what chance gives, an estimate of the Jaccard
similarity of the shingle sets.

Near pairs come from signature bands joined in Spark; every candidate pair is verified by the exact
Jaccard similarity of its shingle sets. Texts of equal signature and shingle set are one class.
Near-duplicates need the links only, not all pairs: a band's classes are dealt over tiles, tasks
compare the signatures at home in a tile with all others of the band, and only classes with an
estimate of at least ``least - SLACK`` bring their shingle sets, for exact counts in an inverted
index of the tile. A pair with a similarity of 0.8 shares no band with a chance of 5e-8 and falls
under the estimate's bound with one of 1e-4; pairs that are more alike are missed more rarely.

Defined results: a null text is empty; a text of fewer than five words is one shingle, one without
words has none, and such texts are alike to each other (1) and to no other (0 but for chance).
Rows that repeat a (doc_id, text) get the same result and count once where the next document is
looked for; texts of one id follow each other by their hash, null ids come last. An empty table
gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

from hashlib import blake2b, sha256
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import (
    chosen, cut, partitions, running_sum, shingle_hashes, shipped, slices, span_hashes, table, text_bytes, words_of,
)
from obsflow.llm.components import connected_components, forest
from obsflow.llm.registry import query

SHINGLE, HASHES, BANDS, LEAST = 5, 128, 32, 0.8
#: Classes at home in a tile, and how far an estimate may be below the least similarity.
TILE, SLACK = 512, 0.14
#: Bytes of text handled at a time.
SLICE = 1 << 20
_random = np.random.default_rng(20240229)
_A = _random.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _random.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingles(texts: pa.Array):
    """64-bit hashes of all shingles of a batch, and their texts."""
    data, offsets = text_bytes(texts)
    starts, ends, owner = words_of(data, offsets)
    return shingle_hashes(span_hashes(data, starts, ends), owner, SHINGLE, len(texts))


def shingle_sets(texts: pa.Array) -> list[bytes]:
    """The sorted distinct shingle hashes of each text, as little-endian bytes."""
    hashes, owner = shingles(texts)
    bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [np.unique(hashes[i:j]).view(np.int64).tobytes() for i, j in zip(bounds[:-1], bounds[1:])]


def signatures(texts: pa.Array) -> np.ndarray:
    """A row of ``HASHES`` 32-bit minima for each text; texts without words have the greatest."""
    hashes, owner = shingles(texts)
    out = np.full((len(texts), HASHES), 0xFFFFFFFF, np.uint32)
    if len(hashes):
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        x = (hashes >> np.uint64(32)).astype(np.uint32)
        permuted = np.empty_like(x)
        for k in range(HASHES):
            np.multiply(x, _A[k], out=permuted)
            permuted += _B[k]
            out[owner[heads], k] = np.minimum.reduceat(permuted, heads)
    return out


def fingerprint(signature: np.ndarray) -> list[bytes]:
    low = np.ascontiguousarray(signature.astype(np.uint8))
    return [row.tobytes() for row in low]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of fingerprints, rows of bytes."""
    return np.clip(((a == b).mean(axis=1) - 1 / 256) / (1 - 1 / 256), 0.0, 1.0)



def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash (of the text), the signature as little-endian bytes and set_hash (of the
    sorted shingle set) of every row."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("row_hash"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = signatures(part.column("text")).astype("<u4")
                sets = [int.from_bytes(blake2b(v, digest_size=8).digest(), "little", signed=True) for v in shingle_sets(part.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("row_hash"),
                     pa.array([row.tobytes() for row in found], pa.binary()), pa.array(sets, pa.int64())],
                    names=["doc_id", "row_hash", "signature", "set_hash"])

    return shipped(rows).mapInArrow(run, f"doc_id {kind}, row_hash long, signature binary, set_hash long")


def _jaccard(batches):
    for batch in batches:
        left, right = (batch.column(c).to_pylist() for c in ("left_set", "right_set"))
        share = []
        for x, y in zip(left, right):
            x, y = np.frombuffer(x, np.int64), np.frombuffer(y, np.int64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            share.append(both / (len(x) + len(y) - both) if len(x) or len(y) else 1.0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(share, pa.float64())], names=["a", "b", "jaccard"])


def _banded(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Membership of every row, a row_hash and signature of each class, and (band, hash, class,
    size) of the bands that ``size`` > 1 classes share."""
    signed = cut(fingerprints(docs).withColumn("class", F.xxhash64("signature", "set_hash")))
    members = signed.select("doc_id", "row_hash", "class")
    width = 4 * HASHES // BANDS
    one = cut(signed.groupBy("class").agg(F.min("row_hash").alias("row_hash"), F.min("signature").alias("signature")))
    bands = one.select("class", F.posexplode(F.array(*(
        F.xxhash64(F.substring("signature", 1 + width * k, width)) for k in range(BANDS)))).alias("band", "hash"))
    # A band of one class makes no pair; the count is combined before the shuffle.
    full = bands.groupBy("band", "hash").agg(F.count("*").alias("size")).filter("size > 1")
    return members, one, cut(bands.join(full, ["band", "hash"]))


def _held(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The shingle set of each class of ``wanted`` (row_hash, class), as little-endian bytes."""
    def sets(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                found = shingle_sets(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("class"), pa.array(found, pa.binary())], names=["class", "shingles"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    texts = docs.select(F.xxhash64(text).alias("row_hash"), text.alias("text")).dropDuplicates(["row_hash"])
    joined = texts.join(wanted.select("row_hash", "class"), "row_hash")
    return cut(shipped(joined).mapInArrow(sets, "class long, shingles binary"))


def near_pairs(docs: DataFrame, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, row_hash, class) of every row, and the pairs of classes (a, b, jaccard)
    with a < b whose shingle sets have a similarity of ``least`` or more.

    A class is named by the hash of its signature and shingle set; the set is read from the member
    text of least hash. Only classes are joined, on (band, hash), never documents.
    """
    members, one, some = _banded(docs)
    pairs = some.alias("x").join(some.alias("y"), ["band", "hash"]).filter("x.class < y.class").select(
        F.col("x.class").alias("a"), F.col("y.class").alias("b")).distinct()
    held = _held(docs, one.join(some.select("class").distinct(), "class", "left_semi"))
    verified = pairs.join(held.toDF("a", "left_set"), "a").join(held.toDF("b", "right_set"), "b").mapInArrow(
        _jaccard, "a long, b long, jaccard double").filter(F.col("jaccard") >= least)
    return members, verified


def _tile_groups(batches, value: str):
    """(key, classes, values, homes) of each tile in a batch, of rows sorted by band, hash and tile,
    those at home first. ``homes`` are (classes, values) of all at home so far; values are bytes."""
    last, classes, values = None, [], []
    for batch in batches:
        band, hash_, tile, own, home, data = (
            batch.column(c).to_pylist() for c in ("band", "hash", "tile", "class", "home", value))
        start = 0
        while start < batch.num_rows:
            key, stop = (band[start], hash_[start], tile[start]), start + 1
            while stop < batch.num_rows and (band[stop], hash_[stop], tile[stop]) == key:
                stop += 1
            if key != last:
                last, classes, values = key, [], []
            n = start + sum(home[start:stop])
            classes, values = classes + own[start:n], values + data[start:n]
            yield key, own[start:stop], data[start:stop], (classes, values)
            start = stop


def _alike(batches, least: float):
    """Rows of tiles, those with a similar one by the signatures, in the first band they share."""
    width = HASHES // BANDS
    for key, classes, values, homes in _tile_groups(batches, "signature"):
        if not homes[0]:
            continue
        x, y = (np.frombuffer(b"".join(v), "<u4").reshape(-1, HASHES) for v in (values, homes[1]))
        ids, at_home = np.array(classes, np.int64), np.array(homes[0], np.int64)
        use, use_home = np.zeros(len(ids), bool), np.zeros(len(at_home), bool)
        for begin in range(0, len(ids), 1024):
            part = x[begin : begin + 1024]
            same = np.zeros((len(part), len(y)), np.int16)
            before = np.zeros(same.shape, bool)
            for k in range(0, HASHES, width):
                equal = [part[:, j, None] == y[None, :, j] for j in range(k, k + width)]
                same += np.sum(equal, axis=0, dtype=np.int16)
                if k < key[0] * width:
                    before |= np.all(equal, axis=0)
            hit = (same >= (least - SLACK) * HASHES) & ~before & (ids[begin : begin + 1024, None] != at_home)
            use[begin : begin + 1024] = hit.any(axis=1)
            use_home |= hit.any(axis=0)
        found = np.unique(np.concatenate([ids[use], at_home[use_home]]))
        n = len(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, key[0], np.int32)), pa.array(np.full(n, key[1], np.int64)),
             pa.array(np.full(n, key[2], np.int32)), pa.array(found), pa.array(np.isin(found, at_home))],
            names=["band", "hash", "tile", "class", "home"])


def _linked(batches, least: float):
    """Links of exact similarity between those at home in a tile and all others, as a forest."""
    for _, classes, values, homes in _tile_groups(batches, "shingles"):
        if not homes[0]:
            continue
        sets = [np.frombuffer(v, np.int64) for v in homes[1]]
        at_home, sizes = np.array(homes[0], np.int64), np.array([len(v) for v in sets])
        all_of = np.concatenate(sets)
        order = np.argsort(all_of, kind="stable")
        all_of, owner = all_of[order], np.repeat(np.arange(len(sets)), sizes)[order]
        left, right = [], []
        for own, value in zip(classes, values):
            value = np.frombuffer(value, np.int64)
            low, high = np.searchsorted(all_of, value, "left"), np.searchsorted(all_of, value, "right")
            n = high - low
            place = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
            both = np.bincount(owner[place], minlength=len(sets))
            either = len(value) + sizes - both
            hit = np.flatnonzero((both >= least * either) & (at_home != own))
            left.append(np.full(len(hit), own, np.int64))
            right.append(at_home[hit])
        a, b = forest(np.concatenate(left), np.concatenate(right))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(docs: DataFrame, least: float = LEAST) -> tuple[DataFrame, DataFrame]:
    """Membership (doc_id, row_hash, class) of every row, and edges (a, b) that connect all classes
    whose shingle sets have a similarity of ``least`` or more."""
    members, one, some = _banded(docs)
    tiles = F.ceil(F.col("size") / TILE).cast("int")
    rows = some.join(one.select("class", "signature"), "class").withColumn(
        "tile", F.explode(F.sequence(F.lit(0), tiles - 1))).withColumn(
        "home", F.pmod(F.xxhash64("class"), tiles) == F.col("tile"))

    def dealt(df):
        return shipped(df).repartition(partitions(df.sparkSession), "band", "hash", "tile").sortWithinPartitions(
            "band", "hash", "tile", F.desc("home"))

    alike = cut(dealt(rows).mapInArrow(
        lambda batches: _alike(batches, least), "band int, hash long, tile int, class long, home boolean").distinct())
    held = _held(docs, one.join(alike.select("class").distinct(), "class", "left_semi"))
    edges = dealt(alike.join(held, "class")).mapInArrow(lambda batches: _linked(batches, least), "a long, b long")
    return members, edges


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, row_hash, class and class_id (least class linked) of every row."""
    members, edges = links(docs, least)
    roots = connected_components(edges)
    return members.join(roots, F.col("class") == F.col("node"), "left").select(
        "doc_id", "row_hash", "class", F.coalesce("root", "class").alias("class_id"))


def one_of_each(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, ASCII letters taken as small: the one of least
    id of each component of texts with a similarity of ``least`` or more stays.

    Of several rows with that id the one of least row hash stays; null ids come last.
    """
    small = F.translate(F.col("text").cast("string"), ascii_uppercase, ascii_lowercase)
    rows = docs.select("doc_id", F.coalesce(small, F.lit("")).alias("text"), F.xxhash64(*sorted(docs.columns)).alias("_hash"))
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("_id"), "_hash")
    texts = rows.groupBy(F.xxhash64("text").alias("row_hash")).agg(F.min(first).alias("first"), F.any_value("text").alias("text"))
    texts = cut(texts)
    found = near_duplicates(texts.select(F.lit(0).cast("long").alias("doc_id"), "text"), least)
    stay = texts.select("row_hash", "first").join(found.select("row_hash", "class_id"), "row_hash").groupBy("class_id").agg(
        F.min("first").alias("first")).select("first._id", "first._hash")
    return chosen(docs, stay)


def _closed(batches):
    """Rows with their text compressed, as n_bytes and packed: the one thing that is shuffled whole."""
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        for part in slices(batch, "text", SLICE):
            texts = part.column("text").cast(pa.large_binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("no_id", "id", "row_hash")), pa.array([len(t) for t in texts], pa.int64()),
                 pa.array([press.compress(t) for t in texts], pa.binary())],
                names=["no_id", "id", "row_hash", "n_bytes", "packed"])


def _opened(batch: pa.RecordBatch):
    """Parts of a batch with at most ``SLICE`` bytes of text (one row at least each), and their texts."""
    opener = zstandard.ZstdDecompressor()
    ends, start = np.cumsum(batch.column("n_bytes").to_numpy()), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + SLICE, "right")))
        part, start = batch.slice(start, stop - start), stop
        sizes = part.column("n_bytes").to_pylist()
        yield part, [opener.decompress(t, max_output_size=n) if n else b""
                     for t, n in zip(part.column("packed").to_pylist(), sizes)]


def edited(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text is the text with its last floor(n_chars / 4) code points replaced by the first
    as many of the next document. Whole texts are shuffled once, compressed, by id and hash; the
    next document's part and fingerprint, never its text, go to the row before it.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # Plain keys without nulls, so that every step below shares one partitioning.
    plain = docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"),
                        F.xxhash64(text).alias("row_hash"), text.alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = f"no_id boolean, id {kind}, row_hash long"
    key = ["no_id", "id", "row_hash"]
    rows = shipped(plain).mapInArrow(_closed, f"{named}, n_bytes long, packed binary")
    ids = plain.select(*key, F.length("text").cast("long").alias("n_chars")).distinct()
    placed = cut(running_sum(ids, [F.col(c) for c in key], "n_chars", "_sum", "place").drop("_sum"))
    total = placed.count()
    to = [f"to_{c}" for c in key]
    wants = placed.select(F.pmod(F.col("place") + 1, F.lit(max(total, 1))).alias("place"), F.floor(F.col("n_chars") / 4).cast("int").alias("k"),
                          *(F.col(c).alias(t) for c, t in zip(key, to)))
    wants = wants.join(placed.select("place", *key), "place").drop("place")
    at_next = rows.join(wants, key)

    def heads(batches):
        for batch in batches:
            for part, texts in _opened(batch):
                found = fingerprint(signatures(pa.array(texts, pa.binary()).view(pa.string())))
                first = [t.decode()[:k] for t, k in zip(texts, part.column("k").to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in to), pa.array(first, pa.string()), pa.array(found, pa.binary())],
                    names=[*key, "head", "next_fingerprint"])

    sent = at_next.select(*to, "k", "n_bytes", "packed").mapInArrow(heads, f"{named}, head string, next_fingerprint binary")
    # Copies of the next row bring the same part again.
    once = sent.groupBy(*key).agg(
        F.any_value("head").alias("head"), F.any_value("next_fingerprint").alias("next_fingerprint"))
    joined = rows.join(once, key).select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "n_bytes", "packed", "head", "next_fingerprint")

    def run(batches):
        for batch in batches:
            for part, texts in _opened(batch):
                strings = [t.decode() for t in texts]
                changed = [t[: len(t) - len(t) // 4] + h for t, h in zip(strings, part.column("head").to_pylist())]
                own = fingerprint(signatures(pa.array(texts, pa.binary()).view(pa.string())))
                other = fingerprint(signatures(pa.array(changed, pa.string())))
                a, b, c = (np.frombuffer(b"".join(x), np.uint8).reshape(-1, HASHES)
                           for x in (own, other, part.column("next_fingerprint").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(t) for t in strings], pa.int64()),
                     pa.array([sha256(t.encode()).hexdigest() for t in changed]), pa.array([x.hex() for x in own]),
                     pa.array([x.hex() for x in other]), pa.array(likeness(a, b)), pa.array(likeness(a, c))],
                    names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    return shipped(joined).mapInArrow(
        run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")


@query("op1_minhash")
def op1_minhash(spark, sf_dir):
    return edited(table(spark, sf_dir, "documents"))
