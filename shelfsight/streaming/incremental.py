"""Incremental standardisation of landed JSON into day partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfsight.functions.columns import calendar_date
from shelfsight.operators.standardize import KEY, keep_last, standardize
from shelfsight.sources.scratch import materialize

DAY = "day"
#: Files of one day at most.
DAY_FILES = 4


def _stored(spark: SparkSession, schema: T.StructType, target: str) -> DataFrame | None:
    """The rows taken in so far; None before the first run has made the folder."""
    try:
        return spark.read.schema(schema).parquet(target)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _contents(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per day: how many rows there are and an order-free sum of their digests."""
    digest = F.xxhash64(F.to_json(F.struct(*columns))).cast("decimal(38,0)")
    return rows.groupBy(DAY).agg(F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("digest"))


def changed_days(kept: DataFrame, stored: DataFrame) -> DataFrame:
    """The rows of `kept` on days whose stored rows differ."""
    columns = kept.columns
    new, old = _contents(kept, columns), _contents(stored.select(*columns), columns)
    same = new.join(old.withColumnRenamed(DAY, "_d"), F.col(DAY).eqNullSafe(F.col("_d")), "left").where(
        new["rows"].eqNullSafe(old["rows"]) & new["digest"].eqNullSafe(old["digest"])
    )
    same = materialize(same.select(F.col("_d"), F.lit(True).alias("_same")), "same-days")
    joined = kept.join(same.withColumnRenamed("_d", "_day"), F.col(DAY).eqNullSafe(F.col("_day")), "left_anti")
    return joined.select(*columns)


def merge_batch(batch: DataFrame, target: str, tie_break: Sequence[str] = (), files: int = DAY_FILES) -> None:
    """Merge one micro-batch into the day partitions it touches, keeping the last arrival.

    The merged rows are written to the scratch folder before the partitions are
    replaced, so a lost executor never re-reads a partition that is being
    overwritten. Replaying a batch gives the same partitions, and a day whose rows do
    not change is not written again. Rows are dealt by day and key, so a day has at
    most `files` files however many tasks there are.
    """
    spark = batch.sparkSession
    arrived = batch.withColumn(DAY, calendar_date("dt"))
    arrived = materialize(arrived, "batch")
    # One value per touched day: bounded by the calendar, not by the rows.
    days = [r[DAY] for r in arrived.select(DAY).distinct().collect()]
    if not days:
        return
    merged, held = arrived, None
    stored = _stored(spark, arrived.schema, target)
    if stored is not None:
        touched = F.col(DAY).isin([d for d in days if d is not None])
        if None in days:
            touched = touched | F.col(DAY).isNull()
        held = stored.where(touched)
        merged = merged.unionByName(held)
    # Keys and arrivals decide, so the day column rides along unchanged.
    kept = materialize(keep_last(merged, KEY, tie_break=tie_break), "merged")
    if held is not None:
        kept = materialize(changed_days(kept, held), "changed")
        if kept.isEmpty():
            return
    part = F.pmod(F.xxhash64(*KEY), F.lit(files)).alias("part")
    (
        kept.repartition(F.col(DAY), part)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(target)
    )


def stream_raw(
    spark: SparkSession,
    landed: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    tie_break: Sequence[str] = (),
    max_files: int = 1000,
) -> StreamingQuery:
    """Take in all newly landed JSON files, then stop; run it as often as needed."""
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(landed)
    return (
        arriving.writeStream.foreachBatch(lambda batch, _: merge_batch(batch, target, tie_break))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_mart(spark: SparkSession, target: str, schema: T.StructType, tie_break: Sequence[str] = ()) -> DataFrame:
    """The standardised mart of everything taken in so far."""
    stored = spark.read.schema(schema).parquet(target)
    return standardize(stored.drop(DAY), tie_break=tie_break)
