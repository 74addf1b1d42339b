"""Seeded hold-out splits and folds, exact in size and repeatable."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.columns import null_safe_join
from shelfsight.operators.selection import digest_cutoffs


def _draw(seed: int, keys: Sequence[str]) -> Column:
    """Seeded digest of a row key: a shuffle order that any run reproduces."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in keys]), 256)


def _quota(size: Column, fraction: float) -> Column:
    return F.greatest(F.ceil(size * F.lit(float(fraction))), F.lit(1)).cast("bigint")


def _cutoffs(drawn: DataFrame, ranks: Callable[[Column], Column]) -> list[str]:
    """The digests at the wanted ranks of a whole table: one per rank."""
    found = digest_cutoffs(drawn, [], "_draw", ranks).first()
    return found["cutoffs"] if found else []


def group_holdout(df: DataFrame, group: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `is_validation`: whole groups, ceil(fraction · groups) of them, at least one."""
    draws = df.select(group).distinct().select(_draw(seed, [group]).alias("_draw"))
    found = _cutoffs(draws, lambda n: F.array(_quota(n, fraction)))
    return df.withColumn("is_validation", _draw(seed, [group]) <= F.lit(found[0]) if found else F.lit(False))


def stratified_holdout(
    df: DataFrame, target: str, keys: Sequence[str], fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Add `is_validation`: ceil(fraction · rows) of each class, at least one.

    Rows that repeat a key stay on one side. Rows without a class are never held out.
    """
    known = df.where(F.col(target).isNotNull())
    drawn = known.select(target, _draw(seed, keys).alias("_draw"))
    found = digest_cutoffs(drawn, [target], "_draw", lambda n: F.array(_quota(n, fraction)))
    cut = found.select(target, F.col("cutoffs")[0].alias("_cut"))
    held = F.coalesce(_draw(seed, keys) <= F.col("_cut"), F.lit(False))
    return null_safe_join(df, cut, [target]).withColumn("is_validation", held).drop("_cut")


def random_holdout(df: DataFrame, keys: Sequence[str], fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add `is_validation`: exactly ceil(fraction · rows) rows, at least one; rows that repeat a key stay together."""
    found = _cutoffs(df.select(_draw(seed, keys).alias("_draw")), lambda n: F.array(_quota(n, fraction)))
    return df.withColumn("is_validation", _draw(seed, keys) <= F.lit(found[0]) if found else F.lit(False))


def group_folds(df: DataFrame, group: str, folds: int, seed: int = 42) -> DataFrame:
    """Add `fold` (0-based): whole groups, fold sizes differing by at most one group."""
    if folds < 2:
        raise ValueError("at least two folds are needed")
    groups = df.select(group).distinct()
    if groups.limit(folds).count() < folds and not df.isEmpty():
        raise ValueError("not enough groups for the folds")
    draws = groups.select(_draw(seed, [group]).alias("_draw"))

    def ends(n: Column) -> Column:
        """The rank of the last group of each fold but the last; the first n % folds have one more."""
        small, wide = F.floor(n / folds), n % folds
        return F.array(*[(k * small + F.least(F.lit(k), wide)).cast("bigint") for k in range(1, folds)])

    own = _draw(seed, [group])
    passed = [(own > F.lit(cut)).cast("int") for cut in _cutoffs(draws, ends)]
    return df.withColumn("fold", sum(passed, F.lit(0)))
