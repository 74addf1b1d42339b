"""Alert rows (category, severity, message, details) from monitoring checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.columns import number
from shelfsight.operators.standardize import union_all
from shelfsight.schemas import numeric_columns
from shelfsight.settings import AlertLimits


def _alert(category: str, severity: str, message: Column, **details: Column) -> list[Column]:
    entries = [part for k, v in details.items() for part in (F.lit(k), v.cast("string"))]
    return [
        F.lit(category).alias("category"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        F.create_map(*entries).alias("details"),
    ]


def missing_ratio(df: DataFrame) -> DataFrame:
    """One row: the mean over columns of their share of missing values."""
    shares = [F.avg(F.col(f"`{c}`").isNull().cast("int")) for c in df.columns]
    return df.agg((sum(shares) / len(shares)).alias("missing_ratio"))


def quality_alerts(df: DataFrame, dataset: str, limits: AlertLimits | None = None) -> DataFrame:
    """An alert when too many values are missing."""
    limits = limits or AlertLimits()
    ratio = F.col("missing_ratio")
    text = F.format_string(f"{dataset} missing ratio %.2f%% exceeds threshold", ratio * 100)
    return (
        missing_ratio(df)
        .where(ratio > 1 - limits.data_quality)
        .select(*_alert("data_quality", "high", text, missing_ratio=ratio))
    )


def accuracy(
    predictions: DataFrame,
    actuals: DataFrame,
    keys: Sequence[str] = ("asin", "site", "snapshot_date"),
) -> DataFrame:
    """One row (pairs, accuracy): 1 − mean absolute percentage error, zero actuals left out.

    The prediction comes from the prediction side even if actuals carry it too.
    """
    left = predictions.select(*keys, number("predicted_revenue").alias("p"))
    right = actuals.select(*keys, number("actual_revenue").alias("a"))
    error = F.try_divide(F.abs(F.col("p") - F.col("a")), F.abs(F.nullif(F.col("a"), F.lit(0.0))))
    return left.join(right, list(keys)).agg(
        F.count(F.lit(1)).alias("pairs"), (1 - F.coalesce(F.avg(error), F.lit(0.0))).alias("accuracy")
    )


def accuracy_alerts(
    predictions: DataFrame,
    actuals: DataFrame,
    keys: Sequence[str] = ("asin", "site", "snapshot_date"),
    limits: AlertLimits | None = None,
) -> DataFrame:
    """An alert when accuracy falls below its threshold."""
    limits = limits or AlertLimits()
    value = F.col("accuracy")
    text = F.format_string("Model accuracy dropped to %.2f%%", value * 100)
    return (
        accuracy(predictions, actuals, keys)
        .where((F.col("pairs") > 0) & (value < limits.accuracy))
        .select(*_alert("performance", "high", text, accuracy=value))
    )


def drift_scores(
    current: DataFrame, baseline: DataFrame, columns: Sequence[str] | None = None
) -> DataFrame:
    """(feature, drift_score): relative shift of each column's mean."""
    columns = list(columns or numeric_columns(current))

    def means(df: DataFrame, name: str) -> DataFrame:
        row = df.agg(*[F.avg(number(c)).alias(c) for c in columns])
        cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias(name)) for c in columns])
        return row.select(F.explode(cells).alias("m")).select("m.*")

    both = means(current, "now").join(means(baseline, "then"), "feature")
    scale = F.when(F.col("then") == 0, 1.0).otherwise(F.abs("then"))
    return both.select("feature", (F.abs(F.col("now") - F.col("then")) / scale).alias("drift_score"))


def drift_alerts(
    current: DataFrame,
    baseline: DataFrame,
    columns: Sequence[str] | None = None,
    limits: AlertLimits | None = None,
) -> DataFrame:
    """One alert per column whose mean moved too far."""
    limits = limits or AlertLimits()
    drift = F.col("drift_score")
    text = F.format_string("Feature %s drift score %.2f exceeds threshold", F.col("feature"), drift)
    return (
        drift_scores(current, baseline, columns)
        .where(drift >= limits.drift)
        .select(*_alert("drift", "medium", text, feature=F.col("feature"), drift_score=drift))
    )


def sla_breaches(runs: DataFrame, limits: AlertLimits | None = None) -> DataFrame:
    """Runs completed later than allowed, with `delay_minutes`."""
    limits = limits or AlertLimits()
    late = F.unix_micros(F.col("completed_at").cast("timestamp")) - F.unix_micros(
        F.col("scheduled_at").cast("timestamp")
    )
    return runs.withColumn("delay_minutes", late / F.lit(60_000_000.0)).where(
        F.col("delay_minutes") > limits.sla_minutes
    )


def sla_alerts(runs: DataFrame, limits: AlertLimits | None = None) -> DataFrame:
    """One alert per late run; none when the needed columns are missing."""
    if not {"scheduled_at", "completed_at", "pipeline"} <= set(runs.columns):
        stamp = F.lit(None).cast("timestamp")
        runs = runs.limit(0).withColumns(
            {"scheduled_at": stamp, "completed_at": stamp, "pipeline": F.lit(None).cast("string")}
        )
    return sla_breaches(runs, limits).select(
        *_alert(
            "sla",
            "high",
            F.lit("SLA breach detected"),
            pipeline=F.col("pipeline"),
            delay_minutes=F.col("delay_minutes"),
        )
    )


def run_alerts(
    quality: DataFrame,
    predictions: DataFrame,
    actuals: DataFrame,
    current: DataFrame,
    baseline: DataFrame,
    runs: DataFrame,
    limits: AlertLimits | None = None,
) -> DataFrame:
    """All alerts of one monitoring run."""
    return union_all(
        [
            quality_alerts(quality, "predictions_daily", limits),
            accuracy_alerts(predictions, actuals, limits=limits),
            drift_alerts(current, baseline, limits=limits),
            sla_alerts(runs, limits),
        ]
    )


def alert_lines(alerts: DataFrame) -> DataFrame:
    """One text line per alert, as sent to notification channels."""
    line = F.format_string("[%s] %s: %s", F.upper("severity"), F.col("category"), F.col("message"))
    return alerts.select(line.alias("line"))
