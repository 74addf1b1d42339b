"""Calendar windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rolling_window_dates(df: DataFrame, end: str, window: int, lookback: int | None = None) -> DataFrame:
    """One row per day of the window ending on each `end` date (column `day`)."""
    length = lookback or window
    days = F.sequence(F.date_sub(end, length - 1), F.col(end))
    return df.withColumn("day", F.explode(days))


def window_pairs(df: DataFrame, day: str, window: int) -> DataFrame:
    """(start, end) of the windows that start on a row's date and end within the range."""
    last = df.agg(F.max(day).alias("last")).scalar()
    pairs = df.select(F.col(day).alias("start"), F.date_add(day, window - 1).alias("end"))
    return pairs.where(F.col("end") <= last)
