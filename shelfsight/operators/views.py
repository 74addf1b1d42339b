"""BI views over the warehouse tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.operators.running import add_size, group_sizes, range_groups, rank_values, running_sums, tile_of
from shelfsight.settings import HOT_ROWS
from shelfsight.sources.scratch import materialize

DAY_SITE = ["snapshot_date", "site"]


def latest_per_key(
    df: DataFrame, keys: Sequence[str], time: str, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The newest row of each key, as a map-side combined aggregate."""
    others = [c for c in df.columns if c not in keys]
    newest = F.struct(time, *(tie_break or [c for c in others if c != time]))
    kept = df.groupBy(*keys).agg(F.max_by(F.struct(*others), newest).alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns])


def features_latest_wide(features: DataFrame) -> DataFrame:
    """Newest feature row per (asin, site)."""
    columns = [
        "asin",
        "site",
        "dt",
        "bsr_trend_7",
        "bsr_trend_30",
        "price_vol_30",
        "review_vel_14",
        "rating_mean_30",
        "est_sales_30",
        "listing_quality",
    ]
    return latest_per_key(features.select(*columns), ["asin", "site"], "dt")


def features_latest_long(history: DataFrame) -> DataFrame:
    """Newest value per (asin, site, feature_name)."""
    columns = ["asin", "site", "feature_name", "feature_value", "snapshot_ts"]
    return latest_per_key(history.select(*columns), columns[:3], "snapshot_ts")


def top_candidates_scored(scores: DataFrame, dim: DataFrame, mart: DataFrame) -> DataFrame:
    """Scored rows with their dimension and mart columns."""
    return (
        scores.select("asin", "site", "dt", "explosive_score", "rank_in_cat")
        .join(mart.select("asin", "site", "dt", "bsr", "price", "reviews_count"), ["asin", "site", "dt"])
        .join(dim.select("asin", "site", "title", "brand", "category_path"), ["asin", "site"])
        .select(
            "asin",
            "site",
            "dt",
            "explosive_score",
            "rank_in_cat",
            "title",
            "brand",
            "category_path",
            "bsr",
            "price",
            "reviews_count",
        )
    )


def top_candidates_daily(
    predictions: DataFrame,
    category_snapshot: DataFrame,
    summaries: DataFrame,
    clusters: DataFrame,
    top: int = 500,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The `top` rows by revenue per day and site, against their category, with AI text.

    Rows are cut to the top before the joins. The quality rank counts all rows of
    the day and site, so it comes from running positions; the revenue rank is a
    group limit that each map task applies to its own rows first.
    """
    best_quality = [F.col("confidence_score").desc_nulls_last(), F.col("asin").asc()]
    ranked = running_sums(predictions, DAY_SITE, best_quality, {"quality_rank": F.lit(1)}, hot_rows)
    best_revenue = Window.partitionBy(*DAY_SITE).orderBy(
        F.col("predicted_revenue").desc_nulls_last(),
        F.col("confidence_score").desc_nulls_last(),
        F.col("asin").asc(),
    )
    ranked = ranked.withColumn("revenue_rank", F.row_number().over(best_revenue)).where(
        F.col("revenue_rank") <= top
    )
    key = ["snapshot_date", "asin", "site"]
    return (
        ranked.join(category_snapshot, ["snapshot_date", "category"], "left")
        .join(summaries.select(*key, F.col("summary_text").alias("ai_comment_summary")), key, "left")
        .join(clusters.select(*key, F.col("cluster_label").alias("ai_keyword_cluster")), key, "left")
        .select(
            "snapshot_date",
            "asin",
            "site",
            "category",
            "predicted_revenue",
            "predicted_units",
            "confidence_score",
            "revenue_rank",
            "quality_rank",
            "avg_category_revenue",
            "avg_category_units",
            (F.col("predicted_revenue") - F.col("avg_category_revenue")).alias("revenue_vs_category"),
            (F.col("predicted_units") - F.col("avg_category_units")).alias("units_vs_category"),
            "ai_comment_summary",
            "ai_keyword_cluster",
        )
    )


def pred_rank_daily(
    predictions: DataFrame,
    tie_break: Sequence[str] = ("asin",),
    tiles: int = 100,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Percent ranks (ascending) and tiles (descending) of revenue and units per day and site."""
    rows = predictions.select(
        "snapshot_date", "asin", "site", "category", "predicted_revenue", "predicted_units"
    )
    # Sizes, ranks and counts each pass over these few columns: write them once.
    rows = materialize(rows, "predictions")
    sizes = group_sizes(rows, DAY_SITE)
    if sizes.largest <= hot_rows:
        rows = range_groups(rows, DAY_SITE, sizes.total)
    for name in ("revenue", "units"):
        value = f"predicted_{name}"
        rows = rank_values(
            rows, DAY_SITE, value, descending=False, rank=f"_rank_{name}", size=f"_size_{name}",
            hot_rows=hot_rows, sizes=sizes,
        )
        order = [F.col(value).desc_nulls_last(), *[F.col(c).asc() for c in tie_break]]
        rows = running_sums(rows, DAY_SITE, order, {f"_pos_{name}": F.lit(1)}, hot_rows, sizes)
    rows = add_size(rows, DAY_SITE, "_rows")
    percent = {
        f"{n}_percentile": F.coalesce(
            F.try_divide(F.col(f"_rank_{n}") - 1, F.col(f"_size_{n}") - 1), F.lit(0.0)
        )
        for n in ("revenue", "units")
    }
    ntile = {f"{n}_ntile": tile_of(F.col(f"_pos_{n}"), F.col("_rows"), tiles) for n in ("revenue", "units")}
    return rows.withColumns(percent | ntile).select(
        "snapshot_date",
        "asin",
        "site",
        "category",
        "predicted_revenue",
        "predicted_units",
        *percent,
        *ntile,
    )


def register_views(views: dict[str, DataFrame]) -> None:
    """Make frames available to SQL under the given names."""
    for name, frame in views.items():
        frame.createOrReplaceTempView(name)


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows of a view, for display."""
    return df.limit(rows)
