"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

Each source gets a token target. Its weight over training time is a line through
a few knots; the integral of that line, scaled to the target, is the demand up to
each time. A document that starts at token `c` of its source's stream gets the
time at which the demand reaches `c`, and documents are range-sorted by it.
Streams are hash-ordered passes over the source. Cumulative sizes come from three
levels of sums (rows of a bucket, buckets of a section, sections of a source), so
no source is ever ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.llm.common import WORD
from shelfsight.llm.ranks import add_before, bucket_of
from shelfsight.sources.scratch import materialize

WEIGHTS = (5, 2, 1)
#: A source's targets stop at so many passes over it.
MOST_PASSES = 3
#: Knots (time, weight) of the sources, repeating as the weights do.
SHAPES = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)))


def pieces(shape: Sequence[tuple[float, float]]) -> Column:
    """The integrated schedule: where each piece starts, in time and in share of the demand."""
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(shape, shape[1:])]
    out, done = [], 0.0
    for (a, b), area in zip(zip(shape, shape[1:]), areas):
        if area > 0:
            names = ("time", "lasts", "from", "to", "begin", "share")
            numbers = (a[0], b[0] - a[0], a[1], b[1], done / sum(areas), area / sum(areas))
            out.append(F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(names, numbers)]))
        done += area
    return F.array(*out)


def invert(schedule: Column, demand: Column) -> Column:
    """The time at which the share `demand` of a source's tokens is used up."""
    piece = F.element_at(F.filter(schedule, lambda p: p["begin"] <= demand), -1)
    inside = (demand - piece["begin"]) / piece["share"]
    low, high = piece["from"], piece["to"]
    part = F.try_divide((low + high) * inside, low + F.sqrt(low * low + (high * high - low * low) * inside))
    return piece["time"] + piece["lasts"] * F.coalesce(part, F.lit(0.0))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """Per source: rows, size, number in code point order (null last) and token target.

    Targets are `least(most * size, weight * level)`, with the level at which they
    sum to all tokens; that is where repeated resharing of the excess ends.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_ratio = Window.orderBy("ratio", "source_no")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    here = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") % len(weights) + 1).cast("int"))
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
        .withColumn("source_no", F.row_number().over(by_name) - 1)
        .withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * most)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(here)
    return (
        ranked.withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "source_no", "level"))).over(whole)["level"])
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.coalesce("level", F.lit(0.0))))
        .select("source", "source_no", "rows", "source_size", "target")
    )


def curriculum(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: Sequence[float] = WEIGHTS,
    shapes: Sequence[Sequence[tuple[float, float]]] = SHAPES,
    carry: bool = False,
) -> DataFrame:
    """Give each row its copies' training positions (0 to 1), in order of the first.

    Returns doc_id, size, source_size, target, taken and positions; with `carry` also
    `_doc`, all input columns as one struct. A copy is taken when its middle token is
    within the target, so a source misses it by less than half a document a pass. A
    null text has size 0; empty texts are never taken and have no positions; the null
    source is one more source, last in order. Rows with equal id, source and size tie,
    and get the same set of results in any order. An empty table gives no rows.
    """
    digest = F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    columns = {
        "doc_id": F.col(id_column),
        "source": F.col(source_column),
        "size": F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)), F.lit(0)).cast("long"),
        "digest": digest,
    }
    kept = [F.struct(*[F.col(c) for c in docs.columns]).alias("_doc")] if carry else []
    sized = docs.select(*[c.alias(n) for n, c in columns.items()], *kept)
    small = materialize(sized.drop("_doc"), "sizes")
    sources = materialize(source_targets(small, weights), "sources")

    same = F.col("source").eqNullSafe(F.col("_source"))
    numbers = sources.withColumnRenamed("source", "_source")
    unit = F.conv(F.substring("digest", 1, 8), 16, 10).cast("double") / 2**32

    def place(df: DataFrame) -> DataFrame:
        bucket = bucket_of(unit, F.col("rows"))
        return df.join(numbers, same).withColumn("bucket", bucket).drop("_source", "source", "rows")

    schedule = F.element_at(F.array(*[pieces(s) for s in shapes]), (F.col("source_no") % len(shapes) + 1).cast("int"))
    passes = F.transform(F.sequence(F.lit(0), F.lit(MOST_PASSES - 1)), lambda p: p * F.col("source_size") + F.col("begin"))
    taken = F.filter(passes, lambda c: (F.col("size") > 0) & (c + F.col("size") / 2 <= F.col("target")))
    placed = add_before(place(sized), place(small), "source_no", ("digest", "doc_id", "size"), F.col("size"), "begin")
    return (
        placed
        .withColumn("_taken", taken)
        .withColumn("positions", F.transform("_taken", lambda c: invert(schedule, c / F.col("target"))))
        .withColumn("taken", F.size("_taken") * F.col("size"))
        .select("doc_id", "size", "source_size", "target", "taken", "positions", *(["_doc"] if carry else []))
    )


def in_order(placed: DataFrame) -> DataFrame:
    """Rows range-sorted by their first position; rows that are not taken come last."""
    # The hash spreads rows without a position over many ranges.
    return placed.orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), F.xxhash64("doc_id"))


def training_rows(placed: DataFrame) -> DataFrame:
    """The documents themselves, a row per taken copy, range-sorted by position."""
    copies = placed.select("_doc", F.explode("positions").alias("_position"))
    return copies.orderBy("_position").select("_doc.*")
