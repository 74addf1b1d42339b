"""Data-quality checks of the daily mart."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.settings import BSR_LIMIT

REQUIRED = ("asin", "site", "dt", "price", "bsr", "rating", "reviews_count", "stock_est", "buybox_seller")


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> list[str]:
    """Required columns the schema lacks; reads no data."""
    return [c for c in required if c not in df.columns]


def date_coverage(df: DataFrame, threshold: float = 0.95) -> DataFrame:
    """Share of rows whose gap to the previous row in date order is one day.

    Only the first row of a date can have a gap above zero, so the rows reduce
    to one counted row per date before they are ordered; that table is as short
    as the calendar. The first row and rows without a date count as covered.
    """
    dates = df.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))
    previous = F.lag("dt").over(Window.orderBy(F.col("dt").asc_nulls_last()))
    follows = F.datediff("dt", previous) == 1
    counts = dates.withColumn("follows", F.coalesce(follows, F.lit(False))).agg(
        F.sum("rows").alias("total"),
        F.sum(F.when(F.col("dt").isNull(), F.col("rows")).otherwise(0)).alias("undated"),
        F.count("dt").alias("dates"),
        F.count_if(F.col("dt").isNotNull() & F.col("follows")).alias("steps"),
    )
    covered = F.col("steps") + F.col("undated") + F.when(F.col("dates") > 0, 1).otherwise(0)
    share = F.try_divide(covered, F.col("total"))
    return counts.select(
        share.alias("coverage"),
        F.when(share >= threshold, "passed").otherwise("warning").alias("status"),
    )


def anomaly_counts(df: DataFrame) -> DataFrame:
    """Counts of non-positive prices and out-of-range ranks (of the columns present)."""
    checks = {
        "price": F.count_if(F.col("price") <= 0).alias("invalid_price"),
        "bsr": F.count_if((F.col("bsr") <= 0) | (F.col("bsr") >= BSR_LIMIT)).alias("invalid_bsr"),
    }
    present = [check for name, check in checks.items() if name in df.columns]
    return df.agg(*(present or [F.lit(None).cast("bigint").alias("invalid_price")]))


@dataclass
class QualityReport:
    """Outcome of `validate_timeseries`; `details` is lazy."""

    missing: list[str] = field(default_factory=list)
    details: DataFrame | None = None

    @property
    def failed(self) -> bool:
        return bool(self.missing)


def validate_timeseries(
    df: DataFrame, required: Sequence[str] = REQUIRED, threshold: float = 0.95
) -> QualityReport:
    """Schema check, then one row of status, coverage and anomaly counts."""
    missing = missing_columns(df, required)
    if missing:
        return QualityReport(missing)
    counts = anomaly_counts(df).select(F.struct("*").alias("counts")).scalar()
    return QualityReport([], date_coverage(df, threshold).select("*", counts.alias("anomalies")))


def reconcile_counts(
    raw: DataFrame, processed: DataFrame, dataset: str = "dataset", tolerance: float = 0.01
) -> DataFrame:
    """Datasets whose processed row count strays from the raw one beyond `tolerance`."""
    before = raw.groupBy(dataset).agg(F.count(F.lit(1)).alias("raw"))
    after = processed.groupBy(dataset).agg(F.count(F.lit(1)).alias("processed"))
    both = before.join(after, dataset, "left").withColumn(
        "processed", F.coalesce("processed", F.lit(0))
    )
    return both.where(F.abs(F.col("raw") - F.col("processed")) / F.col("raw") > tolerance)
