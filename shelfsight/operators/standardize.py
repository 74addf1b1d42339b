"""Raw time series to the daily mart."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.columns import calendar_date, number
from shelfsight.settings import BSR_LIMIT

KEY = ("asin", "site", "dt")


def keep_last(
    df: DataFrame,
    keys: Sequence[str] = KEY,
    arrival: str = "_ingested_at",
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """One row per key: the latest arrival, an unknown arrival counting as latest.

    An aggregate rather than a ranked window: each map task already reduces its
    re-deliveries to one row per key, so a hot key shuffles almost nothing.
    """
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.dropDuplicates(list(keys))
    stamp = [F.col(arrival).isNull(), F.col(arrival)] if arrival in others else []
    newest = F.struct(*stamp, *[F.col(c) for c in tie_break or _sortable(df, others)])
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*others), newest).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def _sortable(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if df.schema[c].dataType.typeName() not in ("map", "variant")]


def valid_price(price: Column) -> Column:
    return F.coalesce(price > 0, F.lit(False))


def valid_bsr(bsr: Column) -> Column:
    return F.coalesce((bsr > 0) & (bsr < BSR_LIMIT), F.lit(False))


def standardize(
    raw: DataFrame, dedup_on: str = "raw", tie_break: Sequence[str] = ()
) -> DataFrame:
    """Deduplicate, coerce numbers, flag and mask invalid values, cut `dt` to a day.

    `dedup_on="raw"` keys on `dt` as delivered; `"date"` cuts to days first, which
    also guarantees one row per product and day.
    """
    if dedup_on not in ("raw", "date"):
        raise ValueError("dedup_on must be 'raw' or 'date'")
    if dedup_on == "date":
        raw = raw.withColumn("dt", calendar_date("dt"))
    rows = keep_last(raw, KEY, tie_break=tie_break)
    rows = rows.withColumns({c: number(c) for c in ("price", "bsr", "rating")})
    rows = rows.withColumns(
        {"price_valid": valid_price(F.col("price")), "bsr_valid": valid_bsr(F.col("bsr"))}
    )
    return rows.withColumns(
        {
            "price": F.when(F.col("price_valid"), F.col("price")),
            "bsr": F.when(F.col("bsr_valid"), F.col("bsr")),
            "dt": calendar_date("dt"),
        }
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns a frame lacks are NULL."""
    if not frames:
        raise ValueError("no frames to combine")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def standardize_all(frames: Sequence[DataFrame], **options) -> DataFrame:
    """Combine several raw frames and standardise the result."""
    return standardize(union_all(frames), **options)
