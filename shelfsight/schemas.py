"""Column layouts of the warehouse tables and of the nested product payload."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Table layouts as DDL text, accepted by readers and `from_json` alike.
DIM_ASIN = (
    "asin string, site string, title string, brand string, category_path array<string>,"
    " first_seen timestamp, last_seen timestamp"
)
TIMESERIES_RAW = (
    "asin string, site string, dt date, price double, bsr bigint, rating double,"
    " reviews_count bigint, stock_est bigint, buybox_seller string, _ingested_at timestamp"
)
MART_DAILY = (
    "asin string, site string, dt date, price double, bsr bigint, rating double,"
    " reviews_count bigint, stock_est bigint, buybox_seller string,"
    " price_valid boolean, bsr_valid boolean"
)
REVIEWS = (
    "asin string, site string, review_id string, dt date, rating bigint, title string,"
    " text string, verified boolean, _ingested_at timestamp"
)
KEYWORDS = (
    "asin string, site string, keyword string, est_search_volume bigint, cpc double,"
    " difficulty double, _ingested_at timestamp"
)
FEATURES_DAILY = (
    "asin string, site string, dt date, bsr_trend_7 double, bsr_trend_30 double,"
    " price_vol_30 double, review_vel_14 bigint, rating_mean_30 double,"
    " est_sales_30 double, listing_quality double"
)
SCORE_DAILY = (
    "asin string, site string, dt date, explosive_score double, reason string, rank_in_cat bigint"
)
PREDICTIONS_DAILY = (
    "snapshot_date date, asin string, site string, category string, predicted_revenue double,"
    " predicted_units double, confidence_score double"
)
CATEGORY_SNAPSHOT = (
    "snapshot_date date, category string, avg_category_revenue double, avg_category_units double"
)
FEATURE_HISTORY = (
    "asin string, site string, feature_name string, feature_value double, snapshot_ts timestamp"
)
AI_SUMMARIES = "snapshot_date date, asin string, site string, summary_text string"
AI_CLUSTERS = "snapshot_date date, asin string, site string, cluster_label string"
ALERTS = "category string, severity string, message string, details map<string,string>"

# The history keeps each series as JSON text: one series may be a list of
# points or a flat numeric list, which no single struct type can describe.
PRODUCT_PAYLOAD = (
    "asin string, domainId int, title string, brand string,"
    " categoryTree array<struct<name:string>>, imagesCSV string,"
    " history map<string,string>,"
    " reviews array<struct<reviewId:string,id:string,timestamp:bigint,rating:bigint,"
    "title:string,text:string,verified:boolean>>,"
    " keywords array<struct<keyword:string,term:string,searchVolume:bigint,cpc:double,"
    "difficulty:double>>"
)
SERIES_POINTS = "array<struct<timestamp:string,time:string,dt:string,value:string>>"


def ensure_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add each missing column as a typed NULL."""
    missing = {name: F.lit(None).cast(kind) for name, kind in columns.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def with_fields(df: DataFrame, **fields: str) -> T.StructType:
    """The schema of `df` with further fields, for functions over Arrow batches."""
    return df.select("*", *[F.lit(None).cast(kind).alias(name) for name, kind in fields.items()]).schema


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of the numeric (or boolean) columns outside `exclude`."""
    kinds = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema.fields if f.name not in exclude and isinstance(f.dataType, kinds)]


def first_present(df: DataFrame, candidates: tuple[str, ...], provided: str | None = None) -> str:
    """The given column if it exists, else the first candidate that does."""
    for name in ((provided,) if provided else ()) + tuple(candidates):
        if name in df.columns:
            return name
    raise KeyError(f"none of the columns {list(candidates)} exists")
