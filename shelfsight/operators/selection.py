"""Exact order statistics by counting: medians and quota cut-offs without ordering a group.

A median is bracketed by two quantiles of a mergeable sketch; one more pass counts what
lies below the bracket and gathers the few values inside it. A quota over digests is found
by counting digest prefixes: the prefix that holds the wanted rank is counted more finely
until few digests share it. Both take as many passes as the size needs, and one plan at
any group size.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.columns import null_safe_join
from shelfsight.sources.scratch import materialize

#: Values (or digests) of one group that are gathered at the end.
GATHERED = 100_000
#: The sketch's rank error is 1 / ACCURACY of the values; brackets are wider than that.
ACCURACY = 1_000
_FIRST = (0.5 - 5 / ACCURACY, 0.5 + 5 / ACCURACY)
_STEPS = 100
#: Hexadecimal digits counted at a time: 4096 prefixes.
DIGITS = 3


def group_medians(df: DataFrame, by: Sequence[str], columns: Sequence[str], gathered: int = GATHERED) -> DataFrame:
    """Exact medians of `columns` per group, ignoring NULL; a group without values has none. Starts Spark jobs."""
    by = list(by)
    quantiles = [F.percentile_approx(c, list(_FIRST), ACCURACY).alias(f"_p_{c}") for c in columns]
    first = df.groupBy(*by).agg(*[F.count(c).alias(f"_n_{c}") for c in columns], *quantiles)
    bounds = {f"_{side}_{c}": F.col(f"_p_{c}")[k] for c in columns for k, side in enumerate(("lo", "hi"))}
    brackets = materialize(first.withColumns(bounds).drop(*[f"_p_{c}" for c in columns]), "brackets")
    # At first the values inside are a known share of all; later they are counted.
    inside = brackets.agg(F.max(F.greatest(*[F.col(f"_n_{c}") for c in columns], F.lit(0)))).first()[0] or 0
    inside *= 2 * (_FIRST[1] - _FIRST[0])
    while inside > gathered:
        brackets, before = _narrowed(df, by, columns, brackets), inside
        inside = brackets.agg(F.max(F.greatest(*[F.col(f"_in_{c}") for c in columns], F.lit(0)))).first()[0] or 0
        brackets = brackets.drop(*[f"_in_{c}" for c in columns])
        if inside >= before:
            break
    joined = _beside(df.select(*by, *columns), brackets.drop(*[f"_n_{c}" for c in columns]), by)
    within = {c: (F.col(c) > F.col(f"_lo_{c}")) & (F.col(c) < F.col(f"_hi_{c}")) for c in columns}
    # Every row is counted in generated code; only the few rows with a value inside are gathered.
    below = joined.groupBy(*by).agg(*[F.count_if(F.col(c) <= F.col(f"_lo_{c}")).alias(f"_low_{c}") for c in columns])
    few = joined.where(reduce(lambda a, b: a | b, [F.coalesce(w, F.lit(False)) for w in within.values()]))
    lists = few.groupBy(*by).agg(*[F.collect_list(F.when(w, F.col(c))).alias(f"_in_{c}") for c, w in within.items()])
    counted = below.unionByName(lists, allowMissingColumns=True).groupBy(*by).agg(
        *[F.sum(f"_low_{c}").alias(f"_low_{c}") for c in columns],
        *[F.flatten(F.collect_list(f"_in_{c}")).alias(f"_in_{c}") for c in columns],
    )
    return _beside(counted, brackets, by).select(*by, *[_middle(c).alias(c) for c in columns])


def _beside(df: DataFrame, found: DataFrame, by: list[str]) -> DataFrame:
    """Each row with its group's values; without groups there is one row of them."""
    if by:
        return null_safe_join(df, found, by)
    (row,) = found.collect()
    return df.withColumns({c: F.lit(row[c]) for c in found.columns})


def _middle(c: str) -> Column:
    """The mean of the two middle values (the same one twice where the number is odd)."""
    n, low = F.col(f"_n_{c}"), F.col(f"_low_{c}")
    ordered = F.array_sort(f"_in_{c}")

    def ranked(rank: Column) -> Column:
        place = (rank - low).cast("int")
        return F.when(place <= 0, F.col(f"_lo_{c}")).otherwise(F.coalesce(F.get(ordered, place - 1), F.col(f"_hi_{c}")))

    return (ranked(F.floor((n + 1) / 2)) + ranked(F.floor(n / 2) + 1)) / 2


def _narrowed(df: DataFrame, by: list[str], columns: Sequence[str], brackets: DataFrame) -> DataFrame:
    """Brackets within the old ones, with the number of values strictly inside each new one as `_in_<column>`."""
    joined = _beside(df.select(*by, *columns), brackets, by)
    points = [k / _STEPS for k in range(_STEPS + 1)]
    parts = []
    for c in columns:
        value, lo, hi = F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}")
        within = F.when((value > lo) & (value < hi), value)
        parts += [
            *[F.max(f"_{p}_{c}").alias(f"_{p}_{c}") for p in ("n", "lo", "hi")],
            F.count_if(value <= lo).alias(f"_before_{c}"),
            F.count(within).alias(f"_in_{c}"),
            F.percentile_approx(within, points, ACCURACY).alias(f"_p_{c}"),
        ]
    found = joined.groupBy(*by).agg(*parts)
    changed = {}
    for c in columns:
        n, size, quantiles = F.col(f"_n_{c}"), F.col(f"_in_{c}"), F.col(f"_p_{c}")

        def share(rank: Column, c=c, size=size) -> Column:
            return F.try_divide(rank - F.col(f"_before_{c}"), size) * _STEPS

        low = F.floor(share(F.floor((n + 1) / 2)) - 1).cast("int")
        high = F.ceil(share(F.floor(n / 2) + 1) + 1).cast("int")
        changed[f"_lo_{c}"] = F.when((low >= 0) & (low <= _STEPS), F.get(quantiles, low)).otherwise(F.col(f"_lo_{c}"))
        changed[f"_hi_{c}"] = F.when((high >= 0) & (high <= _STEPS), F.get(quantiles, high)).otherwise(F.col(f"_hi_{c}"))
    fresh = materialize(
        found.withColumns(changed).drop(*[f"_{p}_{c}" for c in columns for p in ("p", "in", "before")]), "brackets"
    )
    joined = _beside(df.select(*by, *columns), fresh, by)
    inside = [F.count_if((F.col(c) > F.col(f"_lo_{c}")) & (F.col(c) < F.col(f"_hi_{c}"))).alias(f"_in_{c}") for c in columns]
    kept = [F.max(f"_{p}_{c}").alias(f"_{p}_{c}") for c in columns for p in ("n", "lo", "hi")]
    return materialize(joined.groupBy(*by).agg(*kept, *inside), "brackets")


def _holding(bins: str, rank: Column) -> Column:
    """Of ascending (key, c) counts: the key that holds the wanted rank, its count and the rank within it."""
    start = F.struct(F.lit(0).cast("long").alias("before"), F.lit(None).cast("string").alias("key"), F.lit(0).cast("long").alias("c"))

    def step(a: Column, b: Column) -> Column:
        here = F.struct(a["before"].alias("before"), b["key"].alias("key"), b["c"].alias("c"))
        later = F.struct((a["before"] + b["c"]).alias("before"), a["key"].alias("key"), a["c"].alias("c"))
        return F.when(a["key"].isNotNull(), a).when(a["before"] + b["c"] >= rank, here).otherwise(later)

    return F.aggregate(bins, start, step)


def digest_cutoffs(
    drawn: DataFrame, by: Sequence[str], digest: str, ranks: Callable[[Column], Column], gathered: int = GATHERED
) -> DataFrame:
    """`by`, `cutoffs`: the digests at the wanted ranks of each group, smallest first.

    `ranks` turns a group's size into an array of ranks from 1 on. Equal digests go
    together. Starts Spark jobs.
    """
    by = list(by)

    def counted(rows: DataFrame, keys: list[str], key: Column) -> DataFrame:
        bins = rows.groupBy(*keys, key.alias("key")).agg(F.count(F.lit(1)).alias("c"))
        pairs = F.sort_array(F.collect_list(F.struct("key", "c")))
        return bins.groupBy(*keys).agg(pairs.alias("bins"), F.sum("c").alias("n"))

    def chosen(rows: DataFrame, prefix: Column) -> DataFrame:
        found = rows.withColumn("found", _holding("bins", F.col("rank")))
        rest = (F.col("rank") - F.col("found.before")).alias("rank")
        return found.select(*by, "t", rest, prefix.alias("prefix"), F.col("found.c").alias("c"))

    first = counted(drawn, by, F.substring(digest, 1, DIGITS))
    first = first.select(*by, "bins", F.posexplode(ranks(F.col("n"))).alias("t", "rank"))
    state, length = materialize(chosen(first, F.col("found.key")), "prefixes"), DIGITS
    keys = [*by, "t", "rank", "prefix"]

    def members() -> DataFrame:
        right = state.select(*[F.col(c).alias(f"_s_{c}") for c in by], "t", "rank", "prefix")
        same = [drawn[c].eqNullSafe(right[f"_s_{c}"]) for c in by]
        same.append(F.substring(drawn[digest], 1, length) == right["prefix"])
        return drawn.join(right, reduce(lambda a, b: a & b, same)).drop(*[f"_s_{c}" for c in by])

    while (state.agg(F.max("c")).first()[0] or 0) > gathered and length + DIGITS < 64:
        finer = counted(members(), keys, F.substring(digest, length + 1, DIGITS))
        state = materialize(chosen(finer, F.concat("prefix", "found.key")), "prefixes")
        length += DIGITS
    last = counted(members(), keys, F.col(digest)).withColumn("found", _holding("bins", F.col("rank")))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("t", F.col("found.key").alias("key")))), lambda x: x["key"])
    return materialize(last.groupBy(*by).agg(ordered.alias("cutoffs")), "cutoffs")
