"""Running sums and ranks that do not need a whole group in one task.

A window over a group sorts the group in one task, which is fine until one
group holds a large part of the table. Every function here measures the largest
group first (a map-side combined count over the key columns). Up to `hot_rows`
it uses the plain window; beyond that the rows are range-partitioned by group
*and* order, so that a hot group spreads over many slices, each slice is summed
on its own and the totals of the earlier slices are added.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions.columns import null_safe_join
from shelfsight.settings import FEW_SLICES, HOT_ROWS, SLICE_ROWS, TASK_ROWS
from shelfsight.sources.scratch import materialize

_SLICE = "_slice"
_UP_TO_HERE = (Window.unboundedPreceding, Window.currentRow)


class GroupSizes(NamedTuple):
    """Rows of the largest group and of the whole table."""

    largest: int
    total: int


def group_sizes(df: DataFrame, by: Sequence[str]) -> GroupSizes:
    """Measure the groups: a map-side combined count that reads the key columns only."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    found = counts.agg(F.max("_rows").alias("largest"), F.sum("_rows").alias("total")).first()
    return GroupSizes(int(found["largest"] or 0), int(found["total"] or 0))


def spread_keys(df: DataFrame, by: Sequence[str | Column], rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """Deal the rows out by key to so many tasks that each gets about `task_rows` of `rows`.

    A given number of partitions is not merged again by adaptive execution, so the memory
    of a task stays the same as the table grows. A table for which the session's cores are
    tasks enough is left as it is.
    """
    tasks = math.ceil(rows / task_rows)
    return df.repartition(tasks, *by) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def range_groups(df: DataFrame, by: Sequence[str], rows: int, task_rows: int = TASK_ROWS) -> DataFrame:
    """As `spread_keys`, by ranges of whole groups: few large groups do not fall together by their hash.

    The cuts are sampled, so `df` should be a written table.
    """
    tasks = math.ceil(rows / task_rows)
    return df.repartitionByRange(tasks, *by) if tasks > df.sparkSession.sparkContext.defaultParallelism else df


def range_slices(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], sizes: GroupSizes, hot_rows: int
) -> DataFrame:
    """Cut the rows into ranges of (by, order) and number them in `_slice`.

    There are as many slices as keep one at about `hot_rows` rows, whatever the session
    default; beyond FEW_SLICES a slice has SLICE_ROWS rows at least, else a small
    `hot_rows` would make a task of every few rows. The table is written: sampling may
    place the cuts differently when a plan runs again, and all later passes must see the
    same ones.
    """
    default = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    enough = max(math.ceil(sizes.total / SLICE_ROWS), FEW_SLICES)
    slices = max(min(math.ceil(sizes.total / hot_rows), enough), default)
    ranged = df.repartitionByRange(slices, *[F.col(c) for c in by], *order)
    return materialize(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")


def running_sums(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    sums: dict[str, Column],
    hot_rows: int = HOT_ROWS,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Add inclusive running sums of `sums` within `by`, in the total order `order`.

    `order` must be unique within a group; `F.lit(1)` as a sum gives positions.
    Pass `sizes` if the groups have been measured already. Without `by` the one group
    is the whole table, which is sliced at any size.
    """
    by = list(by)
    if sizes is None:
        sizes = group_sizes(df, by)
        df = spread_keys(df, by, sizes.total) if by and sizes.largest <= hot_rows else df
    if by and sizes.largest <= hot_rows:
        window = Window.partitionBy(*by).orderBy(*order).rowsBetween(*_UP_TO_HERE)
        return df.withColumns({name: F.sum(expr).over(window) for name, expr in sums.items()})

    sliced = range_slices(df, by, order, sizes, hot_rows)
    inside = Window.partitionBy(_SLICE, *by).orderBy(*order).rowsBetween(*_UP_TO_HERE)
    local = sliced.withColumns({name: F.sum(expr).over(inside) for name, expr in sums.items()})
    totals = sliced.groupBy(_SLICE, *by).agg(
        *[F.sum(expr).alias(f"_t_{name}") for name, expr in sums.items()]
    )
    # At most one row per slice and group: a group's rows here are its slices.
    earlier = Window.partitionBy(*by).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        _SLICE, *by, *[F.sum(f"_t_{name}").over(earlier).alias(f"_o_{name}") for name in sums]
    )
    joined = null_safe_join(local, offsets, [_SLICE, *by])
    # As in the plain window: a sum is NULL only until the group's first value.
    def added(name: str) -> Column:
        here, before = F.col(name), F.col(f"_o_{name}")
        return F.coalesce(here + before, here, before)

    return joined.withColumns({name: added(name) for name in sums}).drop(_SLICE, *[f"_o_{name}" for name in sums])


def rank_values(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    *,
    descending: bool = True,
    rank: str | None = None,
    dense: str | None = None,
    ties: str | None = None,
    size: str | None = None,
    hot_rows: int = HOT_ROWS,
    sizes: GroupSizes | None = None,
) -> DataFrame:
    """Add the requested rank columns of `value` within `by`; NULL values get no rank.

    `rank` leaves gaps after ties, `dense` does not, `ties` counts the equal
    values and `size` the ranked rows of the group.
    """
    by = list(by)
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    known = F.col(value).isNotNull()
    if sizes is None:
        sizes = group_sizes(df, by)
        df = spread_keys(df, by, sizes.total) if by and sizes.largest <= hot_rows else df
    if sizes.largest <= hot_rows:
        window = Window.partitionBy(*by).orderBy(order)
        wanted = {}
        if rank:
            wanted[rank] = F.when(known, F.rank().over(window).cast("bigint"))
        if dense:
            wanted[dense] = F.when(known, F.dense_rank().over(window).cast("bigint"))
        if ties:
            wanted[ties] = F.when(known, F.count(F.lit(1)).over(Window.partitionBy(*by, value)))
        if size:
            wanted[size] = F.count(value).over(Window.partitionBy(*by))
        return df.withColumns(wanted)

    # Equal values collapse into one counted row before anything is ordered.
    counted = df.where(known).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_ties"))
    running = running_sums(
        counted, by, [order], {"_upto": F.col("_ties"), "_dense": F.lit(1).cast("bigint")}, hot_rows
    )
    table = running.withColumns({"_rank": F.col("_upto") - F.col("_ties") + 1})
    keep = {"_rank": rank, "_dense": dense, "_ties": ties}
    table = table.select(
        *by, value, *[F.col(k).cast("bigint").alias(v) for k, v in keep.items() if v]
    )
    out = null_safe_join(df, table, [*by, value])
    return add_size(out, by, size, F.col(value)) if size else out


def add_size(df: DataFrame, by: Sequence[str], name: str, counted: Column | None = None) -> DataFrame:
    """Add the number of rows (with a non-NULL `counted`) of each row's group.

    Aggregated, written and joined back; a window would hold the whole group in
    one task.
    """
    count = F.count(F.lit(1) if counted is None else counted).alias(name)
    if not by:
        return df.withColumn(name, df.agg(count).scalar())
    return null_safe_join(df, materialize(df.groupBy(*by).agg(count), "sizes"), by)


def top_ranks(
    df: DataFrame, by: Sequence[str], value: str, cutoff: int, name: str, dense: bool = False
) -> DataFrame:
    """Add the descending rank of `value` within `by`, NULL beyond `cutoff`.

    Only the `cutoff` best distinct values of a group can carry a rank. Each map task
    keeps its rows with those (a group limit per salted part, so ties spread, too), equal
    values are counted, and the few counts are ranked per group. The short table is
    written and joined back: as a file its true size is known, so the rows are shuffled
    only if it is not small.
    """
    by = list(by)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = df.where(F.col(value).isNotNull()).select(*by, value, F.pmod(F.monotonically_increasing_id(), F.lit(parts)).alias("_part"))
    inside = Window.partitionBy(*by, "_part").orderBy(F.col(value).desc())
    leading = salted.withColumn("_d", F.dense_rank().over(inside)).where(F.col("_d") <= cutoff)
    counted = leading.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_c"))
    window = Window.partitionBy(*by).orderBy(F.col(value).desc())
    best = counted.withColumn("_d", F.row_number().over(window)).where(F.col("_d") <= cutoff)
    if dense:
        ranked = best.select(*by, value, F.col("_d").cast("bigint").alias(name))
    else:
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        ranked = best.select(
            *by, value, (F.coalesce(F.sum("_c").over(before), F.lit(0)) + 1).alias(name)
        ).where(F.col(name) <= cutoff)
    return null_safe_join(df, materialize(ranked, "top-ranks"), [*by, value])


def tile_of(position: Column, size: Column, tiles: int) -> Column:
    """Which of `tiles` nearly equal blocks a 1-based position falls into (NTILE)."""
    small = F.floor(size / tiles)
    wide = size % tiles
    in_wide = wide * (small + 1)
    # Past the wide blocks `small` is at least 1: were it 0, every row is in one.
    later = wide + F.floor((position - 1 - in_wide) / F.greatest(small, F.lit(1))) + 1
    return F.when(position <= in_wide, F.floor((position - 1) / (small + 1)) + 1).otherwise(later)
