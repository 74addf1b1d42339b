"""Sums before each row within a group, without ordering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.sources.scratch import materialize

BUCKET_ROWS, SECTION_BUCKETS = 500, 2000


def bucket_of(unit: Column, rows: Column) -> Column:
    """The bucket of a row, from a hash in [0, 1) and the rows of its group: about BUCKET_ROWS each."""
    return F.floor(unit * F.ceil(rows / BUCKET_ROWS)).cast("int")


def add_before(
    df: DataFrame, small: DataFrame, group: str, order: Sequence[str], value: Column, name: str = "before"
) -> DataFrame:
    """Add the sum of `value` over the rows earlier in the group, in the order (bucket, *order).

    `df` and `small` hold the same rows (`small` may lack wide columns) with `group` and
    `bucket`. Sums are taken in three levels: rows of a bucket, buckets of a section,
    sections of a group. Rows that tie in `order` are taken in any order.
    """
    none = F.lit(0).cast("long")
    keys = [group, "bucket"]
    section = F.floor(F.col("bucket") / SECTION_BUCKETS).alias("section")
    totals = small.groupBy(*keys).agg(F.sum(value).alias("n"))
    buckets = materialize(totals.select(*keys, "n", section), "buckets")

    def earlier(*by: str) -> Column:
        window = Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("n").over(window), none)

    sections = buckets.groupBy(group, "section").agg(F.sum("n").alias("n"))
    sections = sections.select(group, "section", earlier(group, "section").alias("section_start"))
    starts = (
        buckets.withColumn("bucket_start", earlier(group, "section", "bucket"))
        .join(sections, [group, "section"])
        .select(*keys, (F.col("section_start") + F.col("bucket_start")).alias("_start"))
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inside", F.coalesce(F.sum(value).over(inside), none))
        .join(starts, keys)
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_start", "_inside")
    )
