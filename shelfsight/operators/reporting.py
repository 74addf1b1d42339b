"""Datasets of the weekly report."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.columns import calendar_date
from shelfsight.settings import ReportSettings


def days_up_to(df: DataFrame, report_date: dt.date, days: int) -> DataFrame:
    """Rows of the `days` days ending on `report_date`; a pushed-down date range."""
    first = report_date - dt.timedelta(days=days - 1)
    return df.where(F.col("snapshot_date").between(F.lit(first), F.lit(report_date)))


def weekly_top(view: DataFrame, report_date: dt.date, limit: int = 100) -> DataFrame:
    """The week's rows, newest day and best quality rank first, limited."""
    return (
        days_up_to(view, report_date, 7)
        .orderBy(
            F.col("snapshot_date").desc(),
            F.col("quality_rank").asc(),
            F.col("site").asc(),
            F.col("asin").asc(),
        )
        .limit(limit)
    )


def category_revenue(view: DataFrame, report_date: dt.date, days: int = 14) -> DataFrame:
    """Revenue per day and category over the last `days` days."""
    return (
        days_up_to(view, report_date, days)
        .groupBy("snapshot_date", "category")
        .agg(F.sum("predicted_revenue").alias("predicted_revenue"))
    )


def category_deltas(
    view: DataFrame, report_date: dt.date, days: int = 14, wide: bool = False
) -> DataFrame:
    """Change of each category's revenue between the two latest days.

    With fewer than two days the delta is 0 and its share missing; a previous
    value of zero or none leaves the share missing. `wide` adds one column per
    day (at most `days` of them).
    """
    daily = category_revenue(view, report_date, days).where(F.col("category").isNotNull())
    latest = daily.agg(F.sort_array(F.collect_set("snapshot_date"), asc=False).alias("_days"))
    placed = daily.withColumn("_days", latest.scalar())
    last = F.col("snapshot_date") == F.col("_days")[0]
    previous = F.col("snapshot_date") == F.try_element_at("_days", F.lit(2))
    deltas = placed.groupBy("category").agg(
        F.max(F.size("_days")).alias("_n"),
        F.max(F.when(last, F.col("predicted_revenue"))).alias("_last"),
        F.max(F.when(previous, F.col("predicted_revenue"))).alias("_previous"),
    )
    change = F.col("_last") - F.col("_previous")
    deltas = deltas.select(
        "category",
        F.when(F.col("_n") < 2, 0.0).otherwise(change).alias("delta"),
        F.try_divide(change, F.nullif(F.col("_previous"), F.lit(0.0))).alias("delta_pct"),
    )
    if not wide:
        return deltas
    dates = sorted(r["snapshot_date"] for r in daily.select("snapshot_date").distinct().collect())
    columns = [
        F.max(F.when(F.col("snapshot_date") == F.lit(d), F.col("predicted_revenue"))).alias(d.isoformat())
        for d in dates
    ]
    return daily.groupBy("category").agg(*columns).join(deltas, "category") if columns else deltas


def revenue_anomalies(
    predictions: DataFrame, report_date: dt.date, z_threshold: float = 2.5
) -> DataFrame:
    """The week's rows far from their (site, category) mean, in population z.

    Group statistics are aggregated and joined back, so no group is gathered.
    """
    key = ["site", "category"]
    week = days_up_to(predictions, report_date, 7).select(
        "snapshot_date", *key, F.col("predicted_revenue").cast("double").alias("predicted_revenue")
    )
    stats = week.groupBy(*key).agg(
        F.avg("predicted_revenue").alias("_mean"), F.stddev_pop("predicted_revenue").alias("_std")
    )
    z = (F.col("predicted_revenue") - F.col("_mean")) / F.col("_std")
    return (
        week.join(stats.where(F.col("_std") > 0), key)
        .withColumn("z_score", z)
        .where(F.abs("z_score") >= z_threshold)
        .select("snapshot_date", "predicted_revenue", *key, F.round("z_score", 3).alias("z_score"))
    )


def ai_section(top: DataFrame, source: str, label: str, placeholder: str) -> DataFrame:
    """Distinct AI texts of the report rows; one placeholder row when there are none."""
    needed = {"snapshot_date", "asin", "site", source}
    if needed - set(top.columns):
        raise KeyError(f"missing AI columns: {sorted(needed - set(top.columns))}")
    rows = top.select(
        calendar_date("snapshot_date").alias("snapshot_date"),
        "asin",
        "site",
        F.coalesce(F.col(source), F.lit(placeholder)).alias(label),
    ).distinct()
    filler = rows.agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") == 0)
    return rows.unionByName(filler.select(F.lit(placeholder).alias(label)), allowMissingColumns=True)


@dataclass
class WeeklyReport:
    """Lazy datasets of one report."""

    report_date: dt.date
    top_candidates: DataFrame
    category_deltas: DataFrame
    anomalies: DataFrame
    ai_comment_summaries: DataFrame | None = None
    ai_keyword_clusters: DataFrame | None = None


def weekly_report(
    top_view: DataFrame,
    predictions: DataFrame,
    report_date: dt.date,
    settings: ReportSettings | None = None,
) -> WeeklyReport:
    """All datasets of the report; AI sections are left out where their columns are missing."""
    settings = settings or ReportSettings()
    top = weekly_top(top_view, report_date, settings.max_top_candidates)
    report = WeeklyReport(
        report_date,
        top,
        category_deltas(top_view, report_date, wide=True),
        revenue_anomalies(predictions, report_date, settings.anomaly_z),
    )
    if settings.ai_enabled and {"ai_comment_summary", "ai_keyword_cluster"} <= set(top.columns):
        report.ai_comment_summaries = ai_section(
            top, "ai_comment_summary", settings.summary_label, settings.placeholder
        )
        report.ai_keyword_clusters = ai_section(
            top, "ai_keyword_cluster", settings.keywords_label, settings.placeholder
        )
    return report
