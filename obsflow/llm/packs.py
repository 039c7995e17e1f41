"""Rows of vectors as a few rows of bytes, so that tasks get whole blocks as numpy arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.types as kinds
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def whole(column: str) -> Column:
    """Whether a vector is there and none of its components is null, NaN or infinite."""
    bad = F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~bad


def flat(column: pa.Array, kind: str) -> np.ndarray:
    """The values of a column of numbers or of lists of numbers, one after the other."""
    values = column.flatten() if kinds.is_list(column.type) or kinds.is_large_list(column.type) else column
    return values.to_numpy(zero_copy_only=False).astype(kind)


def pack(columns: dict[str, str], most: int, keys: tuple[str, ...] = ("size",)):
    """For ``mapInArrow`` over rows sorted by ``keys`` (int): part and seq, which number the packs, the
    keys, n, and each of ``columns`` (name: numpy type) as bytes, for each run of up to ``most`` rows."""
    def run(batches):
        part, seq, last, n = TaskContext.get().partitionId(), 0, None, 0
        held: dict = {c: [] for c in columns}

        def packed():
            numbers = [pa.array([x], pa.int32()) for x in (part, seq, *last, n)]
            data = [pa.array([np.concatenate(held[c]).tobytes()], pa.binary()) for c in columns]
            return pa.RecordBatch.from_arrays(numbers + data, names=["part", "seq", *keys, "n", *columns])

        for batch in batches:
            values = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in keys])
            ends = np.r_[np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1, batch.num_rows]
            start = 0
            while start < batch.num_rows:
                key = tuple(values[:, start].tolist())
                if n and (key != last or n == most):
                    yield packed()
                    seq, n, held = seq + 1, 0, {c: [] for c in columns}
                last = key
                stop = min(int(ends[np.searchsorted(ends, start, "right")]), start + most - n)
                rows = batch.slice(start, stop - start)
                for c, kind in columns.items():
                    held[c].append(flat(rows.column(c), kind))
                n, start = n + stop - start, stop
        if n:
            yield packed()
    return run


def packed_schema(columns: dict[str, str], keys: tuple[str, ...] = ("size",)) -> str:
    return ", ".join(["part int, seq int", *(f"{c} int" for c in keys), "n int", *(f"{c} binary" for c in columns)])


def tops(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` rows of each group by score, then vec_id, with their rank from 1.

    Each task keeps its own first ``k`` of a group before the shuffle.
    """
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
