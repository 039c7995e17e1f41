"""Hard-negative mining by angular triangle filtering.

Every row stores its norm and its angles to a few reference directions. By the triangle inequality
the angle between two rows lies between the greatest difference of their angles to a reference and
the least sum; its cosines times the norms bound their score. Bounds are widened by more than
rounding can do, so a row that they leave out can't matter.

Rows are range-partitioned along the reference nearest to them and the angle to it and cut into
blocks, which keep the least and greatest angle to every reference; anchors are packed in the same
manner, so one test of a block and a pack saves their meeting. Where they meet, bounds are taken by
anchor and block, then by row, and only rows whose bounds overlap a window are scored, in integers.

Positives come first: rows with the anchor's label in order of their upper bounds, until no bound
reaches the last one kept. Their scores give the windows of the negatives: for a positive of score
p, rows of other labels with a score from ``SHARE`` percent of p up to p.

Defined results: a row takes no part whose id, label or vector is null or whose vector holds a null,
NaN or infinite component; vectors of other lengths than the anchor's are left out; rows with the
anchor's id are its own; of repeated anchor ids the least (label, vector) is used; positives and
negatives that repeat are listed as often. A positive of a score below 0 has no window. Components
are multiplied as 64-bit integers. An empty table gives an empty result. Other columns don't matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from obsflow.llm.common import cut, partitions, shipped, table
from obsflow.llm.packs import pack, packed_schema, tops, whole
from obsflow.llm.registry import query

EVERY, POSITIVES, NEGATIVES, SHARE, BLOCK, ANCHORS = 100, 5, 5, 80, 4096, 256
#: Reference directions, and rows (those of least hash) among which they are looked for.
REFERENCES, SAMPLE = 16, 4096
#: Angles are stored in 32 bits: how far they, and the cosines taken of them, may be off.
SLACK = 4e-6
_ROWS = {"ids": "<i8", "labels": "<i4", "v": "<i8", "norm": "<f8", "angles": "<f4"}
_ANCHORS = _ROWS | {"reach": "<i8", "positives": "<i8", "scores": "<i8"}


def labelled(vectors: DataFrame, label: Column, column: str = "embedding") -> DataFrame:
    """vec_id, label and v, floor(256 x) of every component, of the rows that take part."""
    rows = vectors.select("vec_id", label.cast("int").alias("label"), F.col(column).alias("v"))
    return rows.filter(whole("v") & F.col("vec_id").isNotNull() & F.col("label").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", F.transform("v", lambda x: F.floor(x.cast("double") * 256)).alias("v"))


def references(vectors: list) -> dict[int, np.ndarray]:
    """Unit directions for each length of a vector: far from each other, among the given ones."""
    found = {}
    by_size: dict = {}
    for v in vectors:
        by_size.setdefault(len(v), []).append(v)
    for size, rows in by_size.items():
        rows = np.array(rows, float).reshape(len(rows), size)
        norms = np.sqrt((rows**2).sum(axis=1))
        rows = rows[norms > 0] / norms[norms > 0, None]
        if not len(rows):
            continue
        chosen, near = [0], rows @ rows[0]
        while len(chosen) < min(REFERENCES, len(rows)):
            chosen.append(int(np.argmin(near)))
            near = np.maximum(near, rows @ rows[chosen[-1]])
        found[size] = rows[chosen]
    return found


def angles_to(rows: np.ndarray, directions: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to all references; a right angle where there is none or no direction."""
    real = rows.astype(float)
    norms = np.sqrt((real**2).sum(axis=1))
    out = np.full((len(rows), REFERENCES), np.pi / 2)
    if directions is not None:
        cosine = real @ directions.T / np.where(norms, norms, 1)[:, None]
        out[:, : len(directions)] = np.where(norms[:, None] > 0, np.arccos(np.clip(cosine, -1, 1)), np.pi / 2)
    return norms, out


def bounds(low, high, other_low, other_high, small, large):
    """Least and greatest score that angles to the references within ``low`` to ``high`` and
    ``other_low`` to ``other_high``, and products of norms from ``small`` to ``large``, allow."""
    gap = np.maximum(np.maximum(other_low - high, low - other_high), 0).max(axis=-1)
    least, most = low + other_low, high + other_high
    total = np.where(most <= np.pi, most, np.where(least >= np.pi, 2 * np.pi - least, np.pi)).min(axis=-1)
    nearest, farthest = np.cos(np.maximum(gap - SLACK, 0)), np.cos(np.minimum(total + SLACK, np.pi))
    spare = 2 + 1e-9 * large
    return (np.where(farthest >= 0, farthest * small, farthest * large) - spare,
            np.where(nearest >= 0, nearest * large, nearest * small) + spare)


def scores_of(rows: np.ndarray, q: np.ndarray) -> np.ndarray:
    reach = int(np.abs(rows).max(initial=0)) * int(np.abs(q).max(initial=0)) * max(1, len(q))
    if reach < 1 << 53:  # sums of doubles are exact
        return (rows.astype(float) @ q.astype(float)).astype(np.int64)
    return rows @ q


def window(positive: int, share: int = SHARE) -> tuple[int, int]:
    """Least and greatest score of a negative, empty for a positive below 0."""
    return -(-share * positive // 100), positive


class Block:
    """Rows of one length with their norms and angles, ordered by label and id."""

    def __init__(self, ids, labels, v, norm, angles):
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.v, self.norm, self.angles = ids[order], labels[order], v[order], norm[order], angles[order]

    def bounds(self, angles, norm, at):
        own, size = self.angles[at].astype(float), self.norm[at] * norm
        return bounds(angles, angles, own, own, size, size)

    def positives(self, anchor, label, q, norm, angles, k: int):
        """Ids and scores of the best ``k`` rows with the anchor's label."""
        at = np.arange(np.searchsorted(self.labels, label, "left"), np.searchsorted(self.labels, label, "right"))
        at = at[self.ids[at] != anchor]
        _, above = self.bounds(angles, norm, at)
        order = np.argsort(-above, kind="stable")
        at, above = at[order], above[order]
        best, scores, start, step = at[:0], np.zeros(0, np.int64), 0, 64
        while start < len(at) and not (len(best) == k and above[start] < scores[-1]):
            some = at[start : start + step]
            best, scores = np.r_[best, some], np.r_[scores, scores_of(self.v[some], q)]
            order = np.lexsort((self.ids[best], -scores))[:k]
            best, scores, start, step = best[order], scores[order], start + step, 2 * step
        return self.ids[best], scores

    def negatives(self, anchor, label, q, norm, angles, positives: np.ndarray, k: int, share: int):
        """For each positive score, ids and scores of the best ``k`` rows of other labels in its window."""
        at = np.flatnonzero((self.labels != label) & (self.ids != anchor))
        below, above = self.bounds(angles, norm, at)
        windows = [window(p, share) for p in positives.tolist()]
        use = np.zeros(len(at), bool)
        for low, high in windows:
            use |= (above >= low) & (below <= high) & (low <= high)
        at = at[use]
        scores = scores_of(self.v[at], q)
        for low, high in windows:
            inside = np.flatnonzero((scores >= low) & (scores <= high))
            best = inside[np.lexsort((self.ids[at[inside]], -scores[inside]))[:k]]
            yield self.ids[at[best]], scores[best]


def _arrays(row, columns: dict[str, str]) -> dict:
    """The columns of a pack as arrays of its n rows."""
    out = {c: np.frombuffer(row[c], kind) for c, kind in columns.items()}
    n = len(out["ids"])
    return {c: x.reshape(n, -1) if c in ("v", "angles", "positives", "scores") else x for c, x in out.items()}


def _meet(batches, visit, names):
    """``visit(block, anchors)`` for the packs of anchors that follow a block, rows sorted by block."""
    key = block = None
    for batch in batches:
        for row in batch.to_pylist():
            if not row["is_anchor"]:
                key, part = row["block"], _arrays(row, _ROWS)
                block = Block(part["ids"], part["labels"], part["v"], part["norm"], part["angles"])
            elif row["block"] == key:
                found = [x for x in visit(block, _arrays(row, _ANCHORS)) if len(x[0])]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=names)


def _find_positives(k: int):
    def visit(block, a):
        for i, number in enumerate(a["ids"].tolist()):
            ids, scores = block.positives(number, a["labels"][i], a["v"][i], a["norm"][i], a["angles"][i].astype(float), k)
            yield np.full(len(ids), number), ids, scores
    return lambda batches: _meet(batches, visit, ["anchor_id", "vec_id", "score"])


def _find_negatives(k: int, share: int):
    def visit(block, a):
        low, high = block.angles.min(axis=0).astype(float), block.angles.max(axis=0).astype(float)
        angles = a["angles"].astype(float)
        below, above = bounds(angles, angles, low, high, a["norm"] * block.norm.min(), a["norm"] * block.norm.max())
        for i, number in enumerate(a["ids"].tolist()):
            n = int(a["reach"][i])
            scores = a["scores"][i, :n]
            if not any(lo <= hi and above[i] >= lo and below[i] <= hi for lo, hi in (window(p, share) for p in scores.tolist())):
                continue
            found = block.negatives(number, a["labels"][i], a["v"][i], a["norm"][i], angles[i], scores, k, share)
            for positive, score, (ids, own) in zip(a["positives"][i].tolist(), scores.tolist(), found):
                full = lambda x, ids=ids: np.full(len(ids), x)
                yield full(number), full(positive), full(score), ids, own
    return lambda batches: _meet(batches, visit, ["anchor_id", "positive_id", "positive_score", "vec_id", "score"])


def indexed(rows: DataFrame) -> DataFrame:
    """``rows`` with norm, angles, and home and near, the nearest reference and the angle to it.

    References are chosen among ``SAMPLE`` rows, those of least hash; every row is indexed.
    """
    sample = rows.select("v").orderBy(F.xxhash64("vec_id", "label", "v"), "vec_id").limit(SAMPLE)
    found = references([r.v for r in sample.collect()])

    def run(batches):
        for batch in batches:
            lists = batch.column("v")
            sizes = np.diff(lists.offsets.to_numpy()) if batch.num_rows else np.zeros(0, int)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            begin = np.cumsum(sizes) - sizes
            norm, angles = np.zeros(batch.num_rows), np.zeros((batch.num_rows, REFERENCES))
            for size in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == size)
                norm[own], angles[own] = angles_to(values[begin[own][:, None] + np.arange(size)], found.get(size))
            angles = angles.astype(np.float32)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * REFERENCES)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norm), pa.ListArray.from_arrays(offsets, pa.array(angles.ravel())),
                 pa.array(angles.argmin(axis=1).astype(np.int32)), pa.array(angles.min(axis=1))],
                names=["vec_id", "label", "v", "norm", "angles", "home", "near"])

    schema = "vec_id long, label int, v array<long>, norm double, angles array<float>, home int, near float"
    return cut(shipped(rows.select("vec_id", "label", "v")).mapInArrow(run, schema))


def _packs(rows: DataFrame, columns: dict[str, str], most: int) -> DataFrame:
    """Packs of rows that lie near each other, with a number, the least and greatest angle to each
    reference, and the least and greatest norm."""
    spark = rows.sparkSession
    # Places in a checkpoint stay; they tell equal rows apart, so that no range grows with them.
    named = rows.withColumn("_row", F.monotonically_increasing_id()).withColumn("size", F.size("v")).withColumnsRenamed(
        {"vec_id": "ids", "label": "labels"})
    dealt = named.repartitionByRange(partitions(spark), "size", "home", "near", "_row").sortWithinPartitions(
        "size", "home", "near", "_row")

    def run(batches):
        for row in pack(columns, most)(batches):
            angles = np.frombuffer(row.column("angles")[0].as_py(), "<f4").reshape(-1, REFERENCES)
            norm = np.frombuffer(row.column("norm")[0].as_py(), "<f8")
            yield pa.RecordBatch.from_arrays(
                [*row.columns, pa.array([angles.min(axis=0).tolist()], pa.list_(pa.float64())),
                 pa.array([angles.max(axis=0).tolist()], pa.list_(pa.float64())), pa.array([norm.min()]), pa.array([norm.max()])],
                names=[*row.schema.names, "low", "high", "small", "large"])

    schema = packed_schema(columns) + ", low array<double>, high array<double>, small double, large double"
    packs = cut(shipped(dealt).mapInArrow(run, schema))
    most_seq = (packs.agg(F.max("seq")).first()[0] or 0) + 1
    return packs.withColumn("number", F.col("part") * most_seq + F.col("seq"))


def _met(blocks: DataFrame, anchors: DataFrame, least: int | None = None) -> DataFrame:
    """Blocks, each followed by the packs of anchors that may have a score in it: with ``least`` those
    whose bounds reach their lowest window, else all of the same length."""
    spark = blocks.sparkSession
    last = blocks.agg(F.max("number")).first()[0]
    shape = ["size", "low", "high", "small", "large"]
    # One narrow row for each block and pack, by the blocks' numbers.
    heads = anchors.select(F.col("number").alias("pack"), *(F.col(c).alias(f"_{c}") for c in shape), *(
        ["bottom", "top"] if least is not None else []), F.explode(F.sequence(F.lit(0), F.lit(last or 0))).alias("number"))
    pairs = heads.join(blocks.select("number", *shape), "number").filter(F.col("size") == F.col("_size"))
    if least is not None:
        def overlapping(batches):
            for batch in batches:
                if batch.num_rows:
                    low, high, low2, high2 = (np.stack(batch.column(c).to_numpy(zero_copy_only=False))
                                              for c in ("low", "high", "_low", "_high"))
                    small, large, small2, large2, bottom, top = (
                        batch.column(c).to_numpy(zero_copy_only=False) for c in ("small", "large", "_small", "_large", "bottom", "top"))
                    below, above = bounds(low, high, low2, high2, small * small2, large * large2)
                    yield batch.select(["number", "pack"]).filter(pa.array((above >= bottom) & (below <= top)))

        pairs = shipped(pairs).mapInArrow(overlapping, "number int, pack int")
    names = ["size", "n", *_ANCHORS]
    none = F.lit(None).cast("binary")
    visits = pairs.select(F.col("number").alias("block"), "pack").join(
        anchors.select(F.col("number").alias("pack"), *names), "pack").select("block", F.lit(True).alias("is_anchor"), *names)
    own = blocks.select(F.col("number").alias("block"), F.lit(False).alias("is_anchor"), *(
        F.col(c) if c in blocks.columns else none.alias(c) for c in names))
    return shipped(own.unionByName(visits)).repartition(partitions(spark), "block").sortWithinPartitions("block", "is_anchor")


def mined(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
          share: int = SHARE) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score of the
    first ``negatives`` of each anchor and positive; ``rows`` has vec_id, label and v (array<long>)."""
    index = indexed(rows)
    blocks = _packs(index, _ROWS, BLOCK)
    chosen = index.filter(is_anchor).groupBy("vec_id").agg(
        F.min(F.struct("label", "v", "norm", "angles", "home", "near")).alias("_a")).select("vec_id", "_a.*")
    chosen = cut(chosen)
    nothing = F.array_repeat(F.lit(0).cast("long"), positives)
    plain = chosen.withColumns({"reach": F.lit(0).cast("long"), "positives": nothing, "scores": nothing})
    found = _met(blocks, _packs(plain, _ANCHORS, ANCHORS)).mapInArrow(
        _find_positives(positives), "anchor_id long, vec_id long, score long")
    best = tops(found, ["anchor_id"], positives)
    # At most ``positives`` a row: a bounded list, filled up to that length for packing.
    lists = best.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("_best"))
    filled = lambda name: F.concat(F.col(f"_best.{name}"), F.array_repeat(
        F.lit(0).cast("long"), positives - F.size("_best")))
    armed = chosen.join(lists, F.col("vec_id") == F.col("anchor_id")).select(
        *chosen.columns, F.size("_best").cast("long").alias("reach"), filled("vec_id").alias("positives"), filled("score").alias("scores"),
        F.array_max("_best.score").alias("_top"), F.array_min(F.filter("_best.score", lambda x: x >= 0)).alias("_low"))
    armed = cut(armed.filter("_low is not null"))
    packs = _packs(armed, _ANCHORS, ANCHORS)
    packs = _with_windows(packs, share)
    hard = _met(blocks, packs, share).mapInArrow(
        _find_negatives(negatives, share), "anchor_id long, positive_id long, positive_score long, vec_id long, score long")
    return tops(hard, ["anchor_id", "positive_id", "positive_score"], negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _with_windows(packs: DataFrame, share: int) -> DataFrame:
    """``packs`` with bottom and top, the least and greatest score that any window of theirs has."""
    def run(batches):
        for batch in batches:
            bottoms, tops_ = [], []
            for scores, reach in zip(batch.column("scores").to_pylist(), batch.column("reach").to_pylist()):
                reach = np.frombuffer(reach, "<i8")
                scores = np.frombuffer(scores, "<i8").reshape(len(reach), -1)
                used = scores[(np.arange(scores.shape[1]) < reach[:, None]) & (scores >= 0)]
                bottoms.append(float(window(int(used.min()), share)[0]))
                tops_.append(float(used.max()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bottoms, pa.float64()), pa.array(tops_, pa.float64())], names=[*batch.schema.names, "bottom", "top"])

    fields = StructType.fromDDL("bottom double, top double").fields
    return cut(shipped(packs).mapInArrow(run, StructType(packs.schema.fields + fields)))


def _shifted() -> Column:
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


SQL = f"""
with e as (
  select vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::int as label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
         list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * c.v[i]))::bigint as score
  from e a, e c where a.vec_id % {EVERY} = 0 and a.vec_id <> c.vec_id and len(a.v) = len(c.v)),
p as (
  select anchor_id, vec_id as positive_id, score as positive_score from s where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= {POSITIVES}),
n as (
  select anchor_id, positive_id, vec_id as negative_id, positive_score, score as negative_score,
         row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank
  from p join s using (anchor_id)
  where not same and {SHARE} * positive_score <= 100 * score and score <= positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= {NEGATIVES}
"""


@query("op12_angular_negatives", SQL)
def op12_angular_negatives(spark, sf_dir):
    rows = labelled(table(spark, sf_dir, "embeddings"), _shifted())
    return mined(rows, F.col("vec_id") % EVERY == 0)
