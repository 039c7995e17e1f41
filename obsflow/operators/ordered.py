"""Row shifts, row numbers and key joins for groups of any size.

A window sorts each group in one task, so a station holding a third of all rows would be one
huge task. Groups are counted first. Those above a fixed bound are range-partitioned along their
own order into cells, every window works on one cell, and only the few rows at the edges of cells
are looked at across them. Groups within the bound take the plain window.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from obsflow.session import counted_side, materialize

CELL = "_cell"
#: Rows one task sorts at most, as far as the order columns can tell rows apart.
MAX_ROWS = 4_000_000
#: Rows one task takes at most where cells are smaller, and tasks up to which a cell may be one's own.
TASK_ROWS, FEW_TASKS = 100_000, 200
#: Tasks that rows with a null join key are dealt out to.
NULL_SHARES = 1024


def _plain(keys, order):
    return Window.partitionBy(*keys).orderBy(*order)


def _oversized(df: DataFrame, keys, max_rows: int) -> DataFrame:
    """Keys, as ``_k0, _k1, ...``, and counted rows ``_n`` of the groups above ``max_rows``."""
    counts = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.count(F.lit(1)).alias("_n"))
    return materialize(counts.filter(F.col("_n") > max_rows))


def _same_group(keys) -> Column:
    """The row's group is ``_k0, _k1, ...``; null keys are a group."""
    return reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.lit(True))


def divide(df: DataFrame, keys, order, max_rows: int = MAX_ROWS):
    """The rows of groups within ``max_rows``, and apart the others with their ``_cell``.

    The second is None where no group is above. ``order`` names columns that together are unique
    within a group. Rows are range-partitioned along keys and ``order`` by sampled quantiles, so
    outliers, nulls, NaN and infinities only end up in the first or last partitions, sorted there
    and cut into cells of ``max_rows`` rows: cells follow ``order``, and no cell is above the bound.
    A partition has ``TASK_ROWS`` rows at most, but for the errors of the sample, or a cell if that
    is larger; so the number of tasks follows the rows and not the number of cells.
    """
    counts = _oversized(df, keys, max_rows)
    groups, total = counts.agg(F.count(F.lit(1)), F.sum("_n")).first()
    if not groups:
        return df, None
    if keys:
        hot = counted_side(counts)
        rest = df.join(hot, _same_group(keys), "left_anti")
        rows = df.join(hot, _same_group(keys), "left_semi")
    else:
        rest, rows = df.limit(0), df
    parts = min(math.ceil(2 * total / max_rows), max(FEW_TASKS, math.ceil(2 * total / TASK_ROWS)))
    ranged = rows.repartitionByRange(parts, *keys, *order).sortWithinPartitions(*keys, *order)
    # The partition in the upper bits, the row's place in it in the lower ones.
    numbered = ranged.withColumn(CELL, F.monotonically_increasing_id())
    place = F.col(CELL).bitwiseAND(2**33 - 1)
    return rest, materialize(numbered.withColumn(
        CELL, F.col(CELL) - place + F.floor(place / max_rows).cast("bigint")))


def shift_rows(
    df: DataFrame, outputs: dict[str, str], n: int, keys, order, max_rows: int | None = None,
) -> DataFrame:
    """Add columns holding the value ``n`` rows earlier (``n`` < 0: later) in the group.

    ``outputs`` maps each new column to the column it shifts.
    """
    keys, order = list(keys), list(order)
    shift = F.lag if n > 0 else F.lead
    distance = abs(n)

    def shifted(window) -> list[Column]:
        return [shift(c, distance).over(window).alias(out) for out, c in outputs.items()]

    rest, cells = divide(df, keys, order, max_rows or MAX_ROWS)
    whole = rest.select("*", *shifted(_plain(keys, order)))
    if cells is None:
        return whole
    within = _plain([*keys, CELL], order)
    local = cells.select(
        "*", *shifted(within),
        (F.lag(F.lit(1), distance).over(within).isNull()).alias("_head"),
        (F.lead(F.lit(1), distance).over(within).isNull()).alias("_tail"),
    )
    # The rows whose partner lies in another cell. The first and last rows of the cells, taken
    # alone, keep every such partner at its distance.
    open_end = F.col("_head") if n > 0 else F.col("_tail")
    edges = local.filter(F.col("_head") | F.col("_tail")).drop(*outputs)
    # Cells come before the order, so that rows equal in it stay on their side of a cut.
    repaired = edges.select("*", *shifted(_plain(keys, [CELL, *order]))).filter(open_end)
    columns = [*df.columns, *outputs]
    return (
        whole.unionByName(local.filter(~open_end).select(*columns))
        .unionByName(repaired.select(*columns))
    )


def row_positions(
    df: DataFrame, keys, order, out: str = "position", max_rows: int | None = None,
) -> DataFrame:
    """Add the 0-based position of each row within its group; ``keys`` may be empty.

    Positions in a divided group are counted per cell and shifted by the sizes of the cells
    before it. Without keys the whole input is one group.
    """
    keys, order = list(keys), list(order)

    def numbered(rows: DataFrame, groups) -> DataFrame:
        number = F.row_number().over(_plain(groups, order)) - 1
        return rows.withColumn(out, number.cast("bigint"))

    rest, cells = divide(df, keys, order, max_rows or MAX_ROWS)
    if cells is None:
        return numbered(rest, keys)
    before = Window.partitionBy(*keys).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    sizes = cells.groupBy(*keys, CELL).agg(F.count(F.lit(1)).alias("_n"))
    offsets = materialize(sizes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(CELL).alias("_c"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    ))
    placed = numbered(cells, [*keys, CELL]).join(
        counted_side(offsets), _same_group(keys) & (F.col(CELL) == F.col("_c"))
    ).select(*df.columns, (F.col(out) + F.col("_before")).alias(out))
    return numbered(rest, keys).unionByName(placed) if keys else placed


def fill_forward(
    df: DataFrame, value: str, keys, order, out: str, max_rows: int | None = None,
) -> DataFrame:
    """Add the last value of ``value`` that is not null, up to and with the row, within its group.

    A divided group takes what its cells lack from the cells before them, one row a cell.
    """
    keys, order = list(keys), list(order)

    def filled(rows: DataFrame, groups) -> DataFrame:
        before = _plain(groups, order).rowsBetween(Window.unboundedPreceding, 0)
        return rows.withColumn(out, F.last(value, ignorenulls=True).over(before))

    rest, cells = divide(df, keys, order, max_rows or MAX_ROWS)
    if cells is None:
        return filled(rest, keys)
    ends = cells.groupBy(*keys, CELL).agg(F.max_by(
        F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy(CELL).rowsBetween(Window.unboundedPreceding, -1)
    carried = materialize(ends.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(CELL).alias("_c"),
        F.last("_end", ignorenulls=True).over(before).alias("_carried"),
    ))
    joined = filled(cells, [*keys, CELL]).join(
        counted_side(carried), _same_group(keys) & (F.col(CELL) == F.col("_c"))
    ).select(*df.columns, F.coalesce(out, "_carried").alias(out))
    return filled(rest, keys).unionByName(joined) if keys else joined


def join_unique(
    left: DataFrame, right: DataFrame, keys, salt_by, how: str = "left",
    max_rows: int | None = None,
) -> DataFrame:
    """Join with a right side that has at most one row per key.

    Keys with more than ``max_rows`` rows on the left are dealt out over several tasks by a hash
    of the ``salt_by`` columns, and their one right row is repeated for each. That adds at most
    total / max_rows rows to the right side.
    """
    keys = list(keys)
    limit = max_rows or MAX_ROWS
    hot = _oversized(left, keys, limit)
    if hot.isEmpty():
        return left.join(right, keys, how)
    shares = counted_side(hot.select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)],
        F.ceil(F.col("_n") / limit).cast("int").alias("_shares")))
    # Null keys match nothing; dealing them out keeps them from gathering in one task.
    nullable = reduce(or_, [F.col(k).isNull() for k in keys])
    width = F.when(nullable, F.lit(NULL_SHARES)).otherwise(F.col("_shares"))
    own = F.pmod(F.xxhash64(*salt_by), width).cast("int")
    dealt = left.join(shares, keys, "left").withColumn("_share", F.coalesce(own, F.lit(0)))
    every = F.sequence(F.lit(0), F.coalesce(F.col("_shares") - 1, F.lit(0)))
    repeated = right.join(shares, keys, "left").withColumn("_share", F.explode(every))
    return dealt.drop("_shares").join(
        repeated.drop("_shares"), [*keys, "_share"], how
    ).drop("_share")
