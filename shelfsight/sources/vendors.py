"""Record mappings of the other vendor feeds, from landed JSON with known schemas."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.operators.standardize import union_all

# The tags of the two keyword vendors.
KEYWORD_SOURCES = ("junglescout", "helium10")

ORDERS_SCHEMA = (
    "AmazonOrderId string, MarketplaceId string, PurchaseDate string,"
    " OrderTotal struct<CurrencyCode:string,Amount:string>,"
    " OrderItems array<struct<ASIN:string,QuantityOrdered:bigint,QuantityShipped:bigint>>"
)
INVENTORY_SCHEMA = (
    "asin string, inventoryDetails struct<fulfillableQuantity:bigint,inboundWorkingQuantity:bigint>,"
    " lastUpdatedTime string"
)
ADS_SCHEMA = (
    "marketplaceId string, date string, impressions bigint, clicks bigint, spend double,"
    " sales double, acos double, cvr double"
)
KEYWORD_SCHEMA = "keyword string, search_volume bigint, difficulty double, cpc double"
ITEM_SCHEMA = (
    "ASIN string,"
    " ItemInfo struct<Title:struct<DisplayValue:string>,"
    "ByLineInfo:struct<Brand:struct<DisplayValue:string>>>,"
    " BrowseNodeInfo struct<BrowseNodes:array<struct<DisplayValue:string>>>,"
    " Images struct<Primary:map<string,struct<URL:string>>>"
)


def keyword_metrics(rows: DataFrame, marketplace: str, source: str) -> DataFrame:
    """Flat keyword rows of one vendor in the common keyword layout."""
    return rows.select(
        "keyword",
        F.lit(marketplace).alias("site"),
        F.col("search_volume").alias("est_search_volume"),
        "difficulty",
        "cpc",
        F.lit(source).alias("_source"),
    )


def all_keyword_metrics(feeds: Mapping[str, DataFrame], marketplace: str) -> DataFrame:
    """The keyword rows of several vendors, tagged by source, as one table."""
    return union_all([keyword_metrics(rows, marketplace, source) for source, rows in feeds.items()])


def order_items(orders: DataFrame) -> DataFrame:
    """One row per order item; the order total repeats on each."""
    item = orders.select("*", F.explode("OrderItems").alias("i"))
    return item.select(
        F.col("i.ASIN").alias("asin"),
        F.col("MarketplaceId").alias("site"),
        F.col("AmazonOrderId").alias("order_id"),
        F.col("i.QuantityOrdered").alias("ordered_units"),
        F.col("i.QuantityShipped").alias("shipped_units"),
        F.col("OrderTotal.CurrencyCode").alias("currency"),
        F.col("OrderTotal.Amount").alias("gross_sales"),
        F.col("PurchaseDate").alias("purchase_date"),
    )


def inventory_rows(summaries: DataFrame, marketplace: str) -> DataFrame:
    """Flat stock quantities."""
    return summaries.select(
        "asin",
        F.lit(marketplace).alias("site"),
        F.col("inventoryDetails.fulfillableQuantity").alias("fulfillable_quantity"),
        F.col("inventoryDetails.inboundWorkingQuantity").alias("inbound_working"),
        F.col("lastUpdatedTime").alias("last_updated"),
    )


def ads_metrics(rows: DataFrame, profile_id: str) -> DataFrame:
    """Advertising metrics of one profile."""
    return rows.select(
        F.lit(profile_id).alias("profile_id"),
        F.col("marketplaceId").alias("site"),
        "date",
        "impressions",
        "clicks",
        "spend",
        "sales",
        "acos",
        "cvr",
    )


def _non_empty(values: Column) -> Column:
    return F.filter(values, lambda v: F.coalesce(v != "", F.lit(False)))


def catalogue_items(items: DataFrame, marketplace: str) -> DataFrame:
    """Dimension rows from nested catalogue items."""
    nodes = F.coalesce("BrowseNodeInfo.BrowseNodes", F.array().cast("array<struct<DisplayValue:string>>"))
    images = F.coalesce(F.map_values("Images.Primary"), F.array().cast("array<struct<URL:string>>"))
    return items.select(
        F.col("ASIN").alias("asin"),
        F.lit(marketplace).alias("site"),
        F.col("ItemInfo.Title.DisplayValue").alias("title"),
        F.col("ItemInfo.ByLineInfo.Brand.DisplayValue").alias("brand"),
        _non_empty(F.transform(nodes, lambda n: n["DisplayValue"])).alias("category_path"),
        _non_empty(F.transform(images, lambda i: i["URL"])).alias("images"),
    )
