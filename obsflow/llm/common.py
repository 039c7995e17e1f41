"""What the operators share: tables, cut lineage, batches, running sums over a global order."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of the white space that separates words.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set = set()
BATCH_BYTES = "4194304b"
_BOUND, _DEFAULT_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def shipped(df: DataFrame) -> DataFrame:
    """``df``, once its session's Python workers have this package, wherever they run.

    Batches to and from the workers are kept to ``BATCH_BYTES`` unless the session sets a bound of
    its own, because texts may be long.
    """
    context, conf = df.sparkSession.sparkContext, df.sparkSession.conf
    if conf.get(_BOUND) == _DEFAULT_BOUND:
        conf.set(_BOUND, BATCH_BYTES)
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp(prefix="obsflow-ship-")) / f"{root.name}.zip"
        with zipfile.ZipFile(path, "w") as packed:
            for file in sorted(root.rglob("*.py")):
                packed.write(file, file.relative_to(root.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)
    return df


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: the session's ``spark.checkpoint.dir``.

    Only where none is set and the session is local, as in tests, a temporary one is used.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or "cluster" in context.master:
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            folder = tempfile.mkdtemp(prefix="obsflow-llm-")
        context.setCheckpointDir(folder)
    return str(context.getCheckpointDir()).rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def partitions(spark: SparkSession, least: int = 12) -> int:
    """Shuffle partitions of the session, for the calls that must name a number."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_fields(df: DataFrame, fields: str) -> tuple[DataFrame, StructType]:
    """``df`` and its schema followed by ``fields``; these replace columns of the same name."""
    extra = StructType.fromDDL(fields)
    taken = {f.name.lower() for f in extra}
    df = df.select(*(c for c in df.columns if c.lower() not in taken))
    return df, StructType(df.schema.fields + extra.fields)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores after it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 2 << 20):
    """Parts of a batch with at most ``max_bytes`` of ``column`` (one row at least each)."""
    values = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all values one after the other, and the n + 1 offsets; null is empty."""
    values = pc.fill_null(values.cast(pa.large_string()), "")
    offsets = np.frombuffer(values.buffers()[1], np.int64)[
        values.offset : values.offset + len(values) + 1]
    if not len(values) or values.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(values) + 1, np.int64)
    data = np.frombuffer(values.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True


def words_of(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = IS_SPACE):
    """Start and end byte of each word, and the index of its text.

    A word is a longest run of bytes that are not white space (not marked in ``between``, by byte);
    texts are split at ``offsets``.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~between[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = inside[edges]
    starts = np.flatnonzero(begins)
    stops = np.zeros(len(data), bool)
    stops[:-1] = inside[:-1] & (~inside[1:] | begins[1:])
    stops[-1] = inside[-1]
    owner = np.searchsorted(offsets, starts, "right") - 1
    return starts, np.flatnonzero(stops) + 1, owner


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_known: dict = {}


def _powers(base: int, n: int) -> np.ndarray:
    if len(_known.get(base, ())) <= n:
        out = np.full(n + (1 << 16), base, np.uint64)
        out[0] = 1
        _known[base] = np.multiply.accumulate(out)
    return _known[base][: n + 1]


def sequence_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of ``values`` (uint64), from one running polynomial over all."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(int(_BASE), len(values))[:-1], out=sums[1:])
    shift = _powers(int(_INVERSE), len(values))[starts]
    return mix((sums[ends] - sums[starts]) * shift + (ends - starts).astype(np.uint64))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    return sequence_hashes(_BYTES[data], starts, ends)


def shingle_hashes(words: np.ndarray, owner: np.ndarray, size: int, texts: int):
    """Hashes of the runs of ``size`` words of each text, repeats included, and their texts.

    A text of fewer words gives its whole sequence, a text without words nothing.
    """
    counts = np.bincount(owner, minlength=texts)
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    place = np.arange(len(words)) - first[owner]
    length = np.minimum(size, counts[owner] - place)
    keep = (length == size) | ((place == 0) & (counts[owner] < size))
    out = np.zeros(len(words), np.uint64)
    for k in range(size):
        shifted = np.zeros(len(words), np.uint64)
        n = max(0, len(words) - k)
        shifted[:n] = words[k : k + n]
        out = np.where(k < length, mix(out * _BASE + shifted), out)
    return out[keep], owner[keep]


def running_sum(df: DataFrame, order: list[Column], value: str, into: str,
                position: str | None = None) -> DataFrame:
    """Rows in global order with the sum of ``value`` over all rows before each.

    Rows are range-partitioned and sorted, each partition adds up its batches in one pass, and the
    totals of the partitions, one row each, shift them. No task sees more than its range.
    ``order`` should tell rows apart where ties must not be broken by chance. With ``position``
    also the row's number, from 0. Null counts as 0.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    _, schema = with_fields(ranged, "_part int, _local long, _row long")

    def add_up(batches):
        part, total, seen = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            values = pc.fill_null(batch.column(value), 0).to_numpy(zero_copy_only=False)
            ends = total + np.cumsum(values, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(values), part, np.int32)),
                 pa.array(ends - values), pa.array(np.arange(seen, seen + len(values)))],
                names=schema.names)
            if len(values):
                total, seen = int(ends[-1]), seen + len(values)

    rows = cut(shipped(ranged).mapInArrow(add_up, schema))
    totals = rows.groupBy("_part").agg(F.max(F.col("_local") + F.coalesce(value, F.lit(0))).alias("_sum"),
                                       F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: small enough to send to every task at any size of the input.
    shift = totals.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sum"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"))
    out = rows.join(F.broadcast(shift), "_part")
    made = [(F.col("_local") + F.col("_sum")).alias(into)]
    if position:
        made.append((F.col("_row") + F.col("_n")).alias(position))
    return out.select(*df.columns, *made)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder as Parquet and read it back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def chosen(docs: DataFrame, stay: DataFrame) -> DataFrame:
    """The rows of ``docs`` with an id and hash (of all columns) in ``stay`` (_id, _hash), once each."""
    rows = docs.select(F.struct("*").alias("doc"), "doc_id", F.xxhash64(*sorted(docs.columns)).alias("row"))
    rows = rows.withColumn("number", F.row_number().over(Window.partitionBy("doc_id", "row").orderBy("doc_id")))
    return rows.filter("number = 1").join(
        stay, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_hash")), "left_semi").select("doc.*")
