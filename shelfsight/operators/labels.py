"""Observation/forecast samples, training targets, time splits and diagnostics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.functions.columns import (
    calendar_date,
    group_key,
    null_safe_join,
    number,
    value_map,
)
from shelfsight.operators.asof import asof_join
from shelfsight.operators.running import rank_values
from shelfsight.schemas import ensure_columns
from shelfsight.settings import HOT_ROWS, LABEL_SPAN, SPLIT_SHARES, LabelThresholds
from shelfsight.sources.scratch import materialize

KEY = ["asin", "site"]
BSR_COLUMNS = (
    "past_bsr_percentile",
    "future_bsr_percentile",
    "past_bsr_rank",
    "future_bsr_rank",
)
TRAIN_TABLES = {"bin": "y_bin", "rank": "y_rank", "reg": "y_reg"}


# Daily sums that spans add up, and the two parts of each.
SUMMED = ("s_sum", "d1", "d2", "bsr_percentile_sum", "bsr_rank_sum")
PARTS = ("_whole", "_rest")
UNIT = float(1 << 20)


def _split_value(column: str) -> dict[str, Column]:
    """A value as a multiple of 1 / UNIT and the rest.

    Running totals of the multiples are exact up to 2^33, and those of the small rests err
    far below a double's last digit, so differences of totals do not show other days' rounding.
    """
    value = F.col(column)
    small = F.abs(value) < 2.0**42
    whole = F.when(small, F.floor(value * UNIT).cast("double") / UNIT).otherwise(value)
    return {f"{column}_whole": whole, f"{column}_rest": F.when(small, value - whole)}


def sample_windows(mart: DataFrame, span: tuple[int, int] = LABEL_SPAN) -> DataFrame:
    """One row per (asin, site, t_ref) with its past and future aggregates.

    Reference days are the days with rows that leave a full observation and
    forecast span inside the key's history. Rows first reduce to one partial per
    key and day (map-side combined), so the calendar-range frames run over a
    history no longer than the calendar, however many rows a key has.
    """
    back, ahead = span
    if min(span) < 1:
        raise ValueError(f"a label needs a day on each side, not {span}")
    absent = [c for c in ("asin", "site", "dt") if c not in mart.columns]
    if absent:
        raise KeyError(f"mart is missing required columns: {', '.join(absent)}")
    optional = {"sales": "double", "bsr_percentile": "double", "bsr_rank": "double"}
    rows = ensure_columns(mart, optional).select(
        *KEY, calendar_date("dt").alias("t_ref"), *[number(c).alias(c) for c in optional]
    )
    rows = rows.where(F.col("asin").isNotNull() & F.col("site").isNotNull() & F.col("t_ref").isNotNull())
    days = rows.groupBy(*KEY, "t_ref").agg(
        F.sum("sales").alias("s_sum"),
        F.count("sales").alias("s_n"),
        F.avg("sales").alias("s_avg"),
        (F.var_pop("sales") * F.count("sales")).alias("s_m2"),
        *[
            part
            for c in ("bsr_percentile", "bsr_rank")
            for part in (F.sum(c).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n"))
        ],
    )
    day = F.unix_date("t_ref")
    whole = Window.partitionBy(*KEY)
    # Squares are taken around the key's mean, so equal sales give spread zero.
    days = days.withColumn("day", day).withColumn(
        "centre", F.try_divide(F.sum("s_sum").over(whole), F.sum("s_n").over(whole))
    )
    offset = F.col("s_avg") - F.col("centre")
    days = days.withColumns({"d1": F.col("s_n") * offset, "d2": F.col("s_m2") + F.col("s_n") * offset * offset})
    days = days.withColumns({name: part for c in SUMMED for name, part in _split_value(c).items()})
    by_day = Window.partitionBy(*KEY).orderBy("day")
    # Frames that start at the key's first day are summed as they grow, once per row; a
    # sliding frame would be summed anew for each row. A span is a difference of two.
    upto = {
        name: by_day.rangeBetween(Window.unboundedPreceding, end)
        for name, end in (("before", -back), ("now", 0), ("ahead", ahead))
    }
    spans = {"past": ("before", "now"), "future": ("now", "ahead")}
    totals = [*[f"{c}{part}" for c in SUMMED for part in PARTS], "s_n", "bsr_percentile_n", "bsr_rank_n"]
    running = {f"{c}_{name}": F.coalesce(F.sum(c).over(w), F.lit(0)) for c in totals for name, w in upto.items()}
    running |= {f"rows_{name}": F.count(F.lit(1)).over(w) for name, w in upto.items()}
    days = days.withColumns(running | {"first_day": F.min("day").over(whole), "last_day": F.max("day").over(whole)})

    def count(column: str, span: str) -> Column:
        low, high = spans[span]
        return F.col(f"{column}_{high}") - F.col(f"{column}_{low}")

    def total(column: str, span: str) -> Column:
        return sum((count(f"{column}{part}", span) for part in PARTS), F.lit(0.0))

    def mean(column: str, n: str, span: str) -> Column:
        return F.try_divide(total(column, span), F.nullif(count(n, span), F.lit(0)))

    shift = mean("d1", "s_n", "past")
    variance = mean("d2", "s_n", "past") - shift * shift
    out = days.select(
        *KEY, "t_ref", "day", "first_day", "last_day",
        total("s_sum", "past").alias("past_sales"),
        total("s_sum", "future").alias("future_sales"),
        (count("rows", "past") / back).alias("past_coverage"),
        (count("rows", "future") / ahead).alias("future_coverage"),
        *[
            mean(f"{c}_sum", f"{c}_n", span).alias(f"{span}_{c}")
            for c in ("bsr_percentile", "bsr_rank") for span in spans
        ],
        mean("s_sum", "s_n", "past").alias("past_mean_sales"),
        F.sqrt(F.when(variance > 0, variance).when(variance <= 0, 0.0)).alias("past_std_sales"),
        mean("s_sum", "s_n", "future").alias("future_mean_sales"),
    )
    inside = (F.col("day") >= F.col("first_day") + back - 1) & (
        F.col("day") <= F.col("last_day") - ahead
    )
    return out.where(inside).select(
        *KEY,
        "t_ref",
        "past_sales",
        "future_sales",
        "past_coverage",
        "future_coverage",
        *BSR_COLUMNS,
        "past_mean_sales",
        "past_std_sales",
        "future_mean_sales",
    )


def _payload(df: DataFrame, columns: list[str]) -> Column:
    """Non-NULL entries as a map when all are numeric, else as JSON text."""
    if not columns:
        return F.lit(None).cast("map<string,double>")
    if all(isinstance(df.schema[c].dataType, T.NumericType) for c in columns):
        return value_map(columns)
    return F.to_json(F.struct(*[_without_nan(df, c) for c in columns]))


def _without_nan(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)):
        return number(column).alias(column)
    return F.col(column)


def attach_features(samples: DataFrame, features: DataFrame | None) -> DataFrame:
    """Attach the latest features known at `t_ref`, plus them as `feature_vector`."""
    if features is None:
        return samples.withColumn("feature_vector", F.lit(None).cast("map<string,double>"))
    features = features.withColumn("dt", calendar_date("dt"))
    names = [c for c in features.columns if c not in (*KEY, "dt")]
    # Samples and features are daily, so a key's times are bounded by the calendar.
    joined = asof_join(samples, features, KEY, "t_ref", "dt", unique_left=True, daily=True)
    return joined.withColumn("feature_vector", _payload(joined, names))


def attach_facts(samples: DataFrame, facts: DataFrame | None) -> DataFrame:
    """Left-join static facts (clashing names get `_fact`) and add them as `metadata`.

    As in the source data, `metadata` holds the sample's own column where names clash.
    """
    if facts is None:
        return samples.withColumn("metadata", F.lit(None).cast("map<string,double>"))
    names = [c for c in facts.columns if c not in (*KEY, "dt")]
    clashes = {c: f"{c}_fact" for c in facts.columns if c not in KEY and c in samples.columns}
    joined = samples.join(facts.withColumnsRenamed(clashes), KEY, "left")
    return joined.withColumn("metadata", _payload(joined, [c for c in names if c in joined.columns]))


def add_group_id(samples: DataFrame) -> DataFrame:
    """site|category_id, plus |price_band if any row of the table has a price band."""
    rows = ensure_columns(samples, {"category_id": "string"})
    parts = [F.col("site"), F.col("category_id")]
    defaults = ["unknown_site", "unknown_category"]
    plain = group_key(parts, defaults)
    if "price_band" not in samples.columns:
        out = rows.withColumn("group_id", plain)
    else:
        banded = group_key([*parts, F.col("price_band")], [*defaults, "unknown_price_band"])
        any_band = samples.agg(F.bool_or(F.col("price_band").isNotNull()).alias("any_band")).scalar()
        out = rows.withColumn("group_id", F.when(any_band, banded).otherwise(plain))
    return out if "category_id" in samples.columns else out.drop("category_id")


def sales_ratio(past: Column, future: Column) -> Column:
    """future/past; infinite for growth from nothing, missing for nothing to nothing."""
    return F.when(past > 0, F.try_divide(future, past)).when(
        (past <= 0) & (future > 0), F.lit(float("inf"))
    )


def binary_target(limits: LabelThresholds) -> Column:
    """1 when sales grew enough (or the ratio is missing) and a BSR signal confirms it."""
    grew = F.col("sales_ratio").isNull() | (F.col("sales_ratio") >= limits.sales_ratio)
    dropped = F.coalesce(F.col("bsr_percentile_drop") >= limits.percentile_drop, F.lit(False))
    climbed = F.coalesce(F.col("bsr_rank_improvement") > limits.rank_gain, F.lit(False))
    return (grew & (dropped | climbed)).cast("int")


def derive_targets(
    samples: DataFrame, thresholds: LabelThresholds | None = None, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add group_id and the regression, ranking and binary targets."""
    thresholds = thresholds or LabelThresholds()
    # Group ids, group sizes and ranks each pass over the samples: write them once.
    samples = materialize(samples, "label-samples")
    rows = ensure_columns(samples, {c: "double" for c in BSR_COLUMNS})
    rows = add_group_id(rows.withColumn("y_reg", F.col("future_sales").cast("double")))
    rows = rank_values(
        rows, ["group_id", "t_ref"], "y_reg", rank="_rank", ties="_ties", size="_size", hot_rows=hot_rows
    )
    average = (F.col("_rank") + (F.col("_ties") - 1) / 2) / F.col("_size")
    rows = rows.withColumns(
        {
            "y_rank": average,
            "sales_ratio": sales_ratio(F.col("past_sales"), F.col("future_sales")),
            "bsr_percentile_drop": F.col("past_bsr_percentile") - F.col("future_bsr_percentile"),
            "bsr_rank_improvement": F.col("past_bsr_rank") - F.col("future_bsr_rank"),
        }
    ).drop("_rank", "_ties", "_size")
    return rows.withColumn("y_bin", binary_target(thresholds))


def split_cutoffs(samples: DataFrame, shares: Mapping[str, float] = SPLIT_SHARES) -> DataFrame:
    """One row with the last day of every split but the last, named `<split>_until`.

    Days that the shares leave over go one each to the first splits.
    """
    total = sum(max(share, 0.0) for share in shares.values())
    if total == 0 or total != sum(shares.values()):
        raise ValueError(f"no split of days has the shares {dict(shares)}")
    # The set of distinct days is bounded by the calendar.
    days = samples.agg(F.sort_array(F.collect_set("t_ref")).alias("days"))
    count = F.size("days")
    whole = [F.floor(F.lit(share / total) * count).cast("int") for share in shares.values()]
    rest = count - sum(whole)
    ends = list(accumulate(days_of + F.when(rest > n, 1).otherwise(0) for n, days_of in enumerate(whole)))

    def day_at(cursor: Column) -> Column:
        return F.try_element_at("days", F.greatest(F.least(cursor, count), F.lit(1)).cast("int"))

    return days.select(*[day_at(end).alias(f"{name}_until") for name, end in list(zip(shares, ends))[:-1]])


def assign_splits(samples: DataFrame, shares: Mapping[str, float] = SPLIT_SHARES) -> DataFrame:
    """Label rows by where `t_ref` falls among the distinct days; without days all are of the first split."""
    *earlier, last = shares
    if not earlier:
        return samples.withColumn("split", F.lit(last))
    cutoffs = split_cutoffs(samples, shares).select(F.struct("*").alias("cutoffs")).scalar()
    split = F.when(cutoffs[f"{earlier[0]}_until"].isNull(), earlier[0])
    for name in earlier:
        split = split.when(F.col("t_ref") <= cutoffs[f"{name}_until"], name)
    return samples.withColumn("split", split.otherwise(last))


def add_target_means(samples: DataFrame) -> DataFrame:
    """Add the mean of y_reg per (split, site) and per split (diagnostics only).

    One aggregate gives the sums of both; its few rows are written and joined back.
    A window over the samples would pull a whole split into one task.
    """
    sums = samples.groupBy("split", "site").agg(F.sum("y_reg").alias("_sum"), F.count("y_reg").alias("_n"))
    split = Window.partitionBy("split")
    means = sums.select(
        "split",
        "site",
        F.try_divide("_sum", "_n").alias("site_mean_y_reg"),
        F.try_divide(F.sum("_sum").over(split), F.sum("_n").over(split)).alias("split_mean_y_reg"),
    )
    return null_safe_join(samples, materialize(means, "target-means"), ["split", "site"])


def label_reports(samples: DataFrame) -> dict[str, DataFrame]:
    """Balance, coverage, mean encoder, global, availability and missingness reports."""
    by_split = samples.groupBy("split")
    present = [c for c in BSR_COLUMNS if c in samples.columns]
    share = [F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in present]
    missing = samples.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in samples.columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing_fraction")) for c in samples.columns]))
    return {
        "balance": samples.groupBy("split", "y_bin").agg(F.count("asin").alias("count")),
        "coverage": by_split.agg(
            F.avg("past_coverage").alias("past_coverage"),
            F.avg("future_coverage").alias("future_coverage"),
        ),
        "mean_encoders": samples.groupBy("split", "site").agg(F.avg("y_reg").alias("site_mean_y_reg")),
        "global_stats": by_split.agg(
            F.avg("y_reg").alias("y_reg_mean"),
            F.stddev_samp("y_reg").alias("y_reg_std"),
            F.count("y_reg").alias("n"),
        ),
        "bsr_availability": by_split.agg(*share) if share else by_split.agg(F.count(F.lit(1)).alias("n")),
        "missingness": missing.select(pairs.alias("p")).select("p.*"),
    }


def train_table(samples: DataFrame, target: str, train_name: str = "train") -> DataFrame:
    """Training rows with the key, split, one target and the payload columns."""
    wanted = ["asin", "site", "t_ref", "split", target, "feature_vector", "metadata"]
    return samples.where(F.col("split") == train_name).select(*[c for c in wanted if c in samples.columns])


@dataclass
class LabelSet:
    """Lazy tables of one label run."""

    samples: DataFrame
    train_samples_bin: DataFrame
    train_samples_rank: DataFrame
    train_samples_reg: DataFrame
    reports: dict[str, DataFrame] = field(default_factory=dict)


def build_labels(
    mart: DataFrame,
    features: DataFrame | None = None,
    facts: DataFrame | None = None,
    span: tuple[int, int] = LABEL_SPAN,
    thresholds: LabelThresholds | None = None,
    shares: Mapping[str, float] = SPLIT_SHARES,
    report_callback: Callable[[str, DataFrame], None] | None = None,
    hot_rows: int = HOT_ROWS,
) -> LabelSet:
    """Samples, as-of features, facts, targets, splits, reports and train tables.

    The labelled samples feed a dozen outputs, so they are written once and each of
    these reads back only the columns it needs.
    """
    enriched = attach_facts(attach_features(sample_windows(mart, span), features), facts)
    samples = assign_splits(derive_targets(enriched, thresholds, hot_rows), shares)
    samples = materialize(add_target_means(samples), "labels")
    reports = label_reports(samples)
    if report_callback is not None:
        for name, frame in reports.items():
            report_callback(name, frame)
    tables = {
        f"train_samples_{task}": train_table(samples, column, next(iter(shares)))
        for task, column in TRAIN_TABLES.items()
    }
    return LabelSet(samples=samples, reports=reports, **tables)
