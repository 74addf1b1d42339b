"""Column expressions shared by the operators; all run inside codegen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def number(column: str | Column) -> Column:
    """Tolerant numeric cast: bad text and NaN become NULL."""
    value = F.col(column) if isinstance(column, str) else column
    return F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))


def calendar_date(column: str | Column) -> Column:
    """Tolerant date: text, dates and timestamps to a day, bad text to NULL."""
    value = F.col(column) if isinstance(column, str) else column
    return value.try_cast("date")


def capped_share(value: Column, full: float) -> Column:
    """value/full limited to 1, staying NULL for NULL (`least` would return 1)."""
    share = value / F.lit(float(full))
    return F.when(share < 1, share).when(value.isNotNull(), F.lit(1.0))


def flag(column: str) -> Column:
    """Boolean view of a flag column, NULL counting as false."""
    return F.coalesce(F.col(column).cast("boolean"), F.lit(False))


def group_key(columns: Sequence[Column], defaults: Sequence[str]) -> Column:
    """Composite key joined by a pipe, each NULL part replaced by its default."""
    parts = [F.coalesce(c.cast("string"), F.lit(d)) for c, d in zip(columns, defaults)]
    return F.concat_ws("|", *parts)


def unit_interval(parts: Sequence[Column]) -> Column:
    """Hash of the non-empty parts, as a number in [0, 1).

    The 104 leading bits of the digest are taken in two exact halves, which
    rounds to the same double as dividing the full 256-bit integer.
    """
    key = F.concat_ws("|", *[F.nullif(p, F.lit("")) for p in parts])
    digest = F.sha2(key, 256)
    high = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    low = F.conv(F.substring(digest, 14, 13), 16, 10).cast("double")
    scale = F.lit(float(2**52))
    return high / scale + low / scale / scale


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match each other; right keys are dropped."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in on})
    condition = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in on]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in on])


def all_null_to_missing(entries: Column) -> Column:
    """Drop NULL values from a map column."""
    return F.map_filter(entries, lambda _, value: value.isNotNull())


def value_map(columns: Sequence[str]) -> Column:
    """Map of column name to double, without the NULL entries."""
    pairs = [part for c in columns for part in (F.lit(c), number(c))]
    return all_null_to_missing(F.create_map(*pairs))


def top_by_size(values: Column, limit: int) -> Column:
    """The `limit` map entries largest in absolute value, as an ordered array."""
    ordered = F.array_sort(
        F.map_entries(values),
        lambda a, b: F.when(F.abs(a["value"]) > F.abs(b["value"]), -1)
        .when(F.abs(a["value"]) < F.abs(b["value"]), 1)
        .when(a["key"] < b["key"], -1)
        .when(a["key"] > b["key"], 1)
        .otherwise(0),
    )
    return F.slice(ordered, 1, limit)
