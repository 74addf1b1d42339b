"""Backward as-of join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.functions.columns import null_safe_join
from shelfsight.operators.running import group_sizes, range_slices
from shelfsight.settings import HOT_ROWS

_UP_TO_HERE = (Window.unboundedPreceding, 0)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    unique_left: bool = False,
    daily: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Attach to each left row the latest right row at or before its time.

    The whole right row is taken, also where its fields are NULL; without one the
    fields are NULL. Both sides reduce to one row per key and time and are merged
    in time order, so no pair of rows is ever formed; the answers are joined back
    by key and time. `unique_left` says that left already has one row per key and
    time, which saves that join. `daily` says that times are days, so a key is no
    longer than the calendar; else the keys are measured and hot ones are cut.
    """
    keys = list(keys)
    fields = [c for c in right.columns if c not in (*keys, right_time)]
    # One right row per key and time; equal times resolve to the largest row.
    known = right.where(F.col(right_time).isNotNull()).groupBy(
        *keys, F.col(right_time).alias("_at")
    ).agg(F.max(F.struct(*fields)).alias("_match"))
    carried = [c for c in left.columns if c not in (*keys, left_time)] if unique_left else []
    asked = left.select(*keys, F.col(left_time).alias("_at"), *carried)
    if not unique_left:
        asked = asked.distinct()
    events = known.withColumn("_ask", F.lit(False)).unionByName(
        asked.withColumn("_ask", F.lit(True)), allowMissingColumns=True
    )
    # Within one time the right row sorts first, so an exact match is visible.
    order = [F.col("_at").asc_nulls_first(), F.col("_ask").asc()]
    filled = _last_known(events, keys, order, daily, hot_rows).where("_ask")
    matched = filled.select(
        *keys, F.col("_at").alias(left_time), *carried, *[F.col(f"_match.`{f}`").alias(f) for f in fields]
    )
    if unique_left:
        return matched.select(*left.columns, *fields)
    return left.join(matched, [*keys, left_time], "left")


def _last_known(
    events: DataFrame, keys: list[str], order: list[Column], daily: bool, hot_rows: int
) -> DataFrame:
    """Carry the last non-NULL `_match` forward within each key."""
    last = F.last("_match", ignorenulls=True)
    sizes = None if daily else group_sizes(events, keys)
    if sizes is None or sizes.largest <= hot_rows:
        window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*_UP_TO_HERE)
        return events.withColumn("_match", last.over(window))

    sliced = range_slices(events, keys, order, sizes, hot_rows)
    inside = Window.partitionBy("_slice", *keys).orderBy(*order).rowsBetween(*_UP_TO_HERE)
    newest = F.max_by("_match", F.struct("_at", ~F.col("_ask"))).alias("_carry")
    ends = sliced.where(F.col("_match").isNotNull()).groupBy("_slice", *keys).agg(newest)
    present = sliced.select("_slice", *keys).distinct()
    ends = null_safe_join(present, ends, ["_slice", *keys])
    # At most one row per slice and key.
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.withColumn("_carry", F.last("_carry", ignorenulls=True).over(earlier))
    local = sliced.withColumn("_match", last.over(inside))
    joined = null_safe_join(local, carry, ["_slice", *keys])
    return joined.withColumn("_match", F.coalesce("_match", "_carry")).drop("_slice", "_carry")
