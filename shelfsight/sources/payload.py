"""Nested product payloads to the dim, time-series, review and keyword tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.schemas import PRODUCT_PAYLOAD, SERIES_POINTS

# Marketplace codes, price series in order of preference, tags.
DOMAIN_SITES = {
    1: "US",
    2: "UK",
    3: "DE",
    4: "FR",
    5: "JP",
    6: "CA",
    8: "IT",
    9: "ES",
    10: "IN",
    11: "MX",
    12: "AU",
}
DEFAULT_SITE = "US"
PRICE_SERIES = ("buyBoxPrice", "newPrice", "new", "buyBoxSalePrice")
SOURCE_TAG = "keepa"
FETCH_FAILED = "keepa_fetch_failed"

DOCUMENT = ["asin", "site", "_ingested_at", "_document"]

# metric -> divisor of its series values; the seller series holds text.
SCALES = {"price": 100, "bsr": 1, "rating": 100, "reviews_count": 1, "stock_est": 1}
METRICS = (*SCALES, "buybox_seller")
#: Elements of an array that are added up one by one.
RUN = 8


def site_of(domain: Column) -> Column:
    """Marketplace of a domain number; unknown numbers fall back to the default site."""
    sites = F.create_map(*[F.lit(x) for pair in DOMAIN_SITES.items() for x in pair])
    return F.coalesce(F.try_element_at(sites, F.coalesce(domain.cast("int"), F.lit(-1))), F.lit(DEFAULT_SITE))


def parse_products(landed: DataFrame, payload: str = "payload", arrival: str = "_ingested_at") -> DataFrame:
    """Typed product rows from JSON text; one row is one delivered document.

    `_document` tells apart two deliveries that carry the same arrival time.
    """
    product = F.from_json(F.col(payload), PRODUCT_PAYLOAD)
    stamp = F.col(arrival) if arrival in landed.columns else F.current_timestamp()
    return (
        landed.select(product.alias("p"), F.col(payload).alias("raw"), stamp.alias("_ingested_at"))
        .select("p.*", "raw", "_ingested_at", F.xxhash64("raw").alias("_document"))
        .withColumn("site", site_of(F.col("domainId")))
    )


def dim_rows(products: DataFrame) -> DataFrame:
    """Dimension row per document, with category path and image list."""
    names = F.transform(F.coalesce("categoryTree", F.array().cast("array<struct<name:string>>")), lambda n: n["name"])
    return products.select(
        "asin",
        "site",
        "title",
        "brand",
        F.filter(names, lambda n: F.coalesce(n != "", F.lit(False))).alias("category_path"),
        F.filter(F.split(F.coalesce("imagesCSV", F.lit("")), ","), lambda i: i != "").alias("images"),
        F.col("_ingested_at").alias("first_seen"),
        F.col("_ingested_at").alias("last_seen"),
    )


def _first_series(entries: Column) -> Column:
    """JSON text of the first entry of a JSON object; NULL for anything else."""
    is_object = F.ltrim(entries).startswith("{")
    return F.try_element_at(
        F.map_values(F.from_json(F.when(is_object, entries), "map<string,string>")), F.lit(1)
    )


def _series_columns() -> dict[str, Column]:
    """The JSON text of each metric's series."""
    history = F.col("history")
    empty = F.col("_ranks").isNull() | F.col("_ranks").isin("", "{}", "[]", "0", "false", "null")
    ranks = F.when(empty, history["salesRank"]).otherwise(F.col("_ranks"))
    price = F.lit(None).cast("string")
    for name in reversed(PRICE_SERIES):
        # Presence of the key decides, not its value: a null series still wins.
        price = F.when(F.map_contains_key(history, F.lit(name)), history[name]).otherwise(price)
    return {
        "bsr": _first_series(ranks),
        "price": price,
        "rating": history["rating"],
        "reviews_count": history["reviewCount"],
        "stock_est": history["stock"],
        "buybox_seller": history["buyBoxSeller"],
    }


POINT_LIST = r"^\s*\[\s*\{"
NUMBER_LIST = r"^\s*\[\s*[-+.0-9]"


def _listed_points(points: Column) -> Column:
    """Array of (seconds, value) of a parsed point list, without the empty points."""
    stamped = F.transform(
        points,
        lambda p: F.struct(
            F.coalesce(p["timestamp"], p["time"], p["dt"]).try_cast("double").cast("bigint").alias("seconds"),
            p["value"].alias("value"),
        ),
    )
    return F.filter(stamped, lambda p: p["seconds"].isNotNull() & p["value"].isNotNull())


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where `use` names it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running_total(steps: Column) -> Column:
    """Running sum inside an array of doubles.

    Sums of whole runs of `RUN` elements are folded first; an element then adds up only
    the part of its own run, so a long array costs no more per element than a run.
    """
    zero = F.lit(0.0)

    def summed(array: Column, run: Column, size: Column | int) -> Column:
        return F.aggregate(F.slice(array, run * RUN + 1, size), zero, lambda a, x: a + x)

    def totals(array: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor(F.greatest(F.size(array) - 1, F.lit(0)) / RUN).cast("int"))
        ends = F.aggregate(
            runs, F.array(zero), lambda e, run: F.concat(e, F.array(F.element_at(e, -1) + summed(array, run, RUN)))
        )

        def until(e: Column) -> Column:
            def one(_: Column, i: Column) -> Column:
                run = F.floor(i / RUN).cast("int")
                return F.get(e, run) + summed(array, run, i % RUN + 1)

            return F.transform(array, one)

        return bound(ends, until)

    return bound(steps, totals)


def _flat_points(minutes: Column, values: Column) -> Column:
    """Array of (seconds, value) of a flat series; an odd tail has no value and goes."""
    pairs = F.arrays_zip(minutes.alias("minutes"), values.alias("value"))
    points = F.transform(
        pairs,
        lambda p: F.struct(
            (p["minutes"] * 60).cast("bigint").alias("seconds"), p["value"].cast("string").alias("value")
        ),
    )
    return F.filter(points, lambda p: p["value"].isNotNull())


def decoded_series(products: DataFrame) -> DataFrame:
    """The document key and one array of (seconds, value) per metric, decoded inside the row.

    Both encodings are read: lists of point objects, and flat lists in which minutes are
    steps from the point before.
    """
    ready = products.withColumn("_ranks", F.col("history")["salesRanks"])
    texts = ready.select(*DOCUMENT, *[s.alias(f"_text_{m}") for m, s in _series_columns().items()])
    columns = {}
    for m in METRICS:
        text = F.col(f"_text_{m}")
        columns[f"_points_{m}"] = F.from_json(F.when(F.regexp_like(text, F.lit(POINT_LIST)), text), SERIES_POINTS)
        columns[f"_list_{m}"] = F.from_json(F.when(F.regexp_like(text, F.lit(NUMBER_LIST)), text), "array<double>")
    parsed = texts.withColumns(columns).drop(*[f"_text_{m}" for m in METRICS])
    split = {}
    for m in METRICS:
        numbers = F.when(~F.exists(f"_list_{m}", lambda x: x.isNull()), F.col(f"_list_{m}"))
        minutes = F.filter(numbers, lambda _, i: i % 2 == 0)
        split[f"_steps_{m}"] = F.transform(minutes, lambda x: x.cast("bigint").cast("double"))
        split[f"_values_{m}"] = F.filter(numbers, lambda _, i: i % 2 == 1)
    flat = {m: _flat_points(running_total(F.col(f"_steps_{m}")), F.col(f"_values_{m}")) for m in METRICS}
    return parsed.withColumns(split).select(
        *DOCUMENT, *[F.coalesce(_listed_points(F.col(f"_points_{m}")), flat[m]).alias(m) for m in METRICS]
    )


def timeseries_rows(products: DataFrame) -> DataFrame:
    """Daily panel per document: of each metric the last point of a day, in series order.

    The points of all metrics are sorted by day within the row and cut where the day
    changes, so a document's days come out of one explode: nothing is shuffled and no
    point leaves the task that read it.
    """
    def dated(number: int, m: str) -> Column:
        points = F.coalesce(F.col(m), F.array().cast("array<struct<seconds:bigint,value:string>>"))
        return F.transform(
            points,
            lambda p, i: F.struct(
                F.to_date(F.timestamp_seconds(p["seconds"])).alias("dt"), F.lit(number).alias("metric"), i.alias("pos"),
                p["value"].alias("value"),
            ),
        )

    series = decoded_series(products)
    every = series.select(*DOCUMENT, F.array_sort(F.flatten(F.array(*[dated(k, m) for k, m in enumerate(METRICS)]))).alias("_all"))

    def last_of_day(points: Column) -> Column:
        def last(p: Column, i: Column) -> Column:
            later = F.get(points, i + 1)
            return later.isNull() | (later["dt"] != p["dt"]) | (later["metric"] != p["metric"])

        return F.filter(points, last)

    def by_day(points: Column) -> Column:
        places = F.when(F.size(points) > 0, F.sequence(F.lit(0), F.size(points) - 1))
        begins = F.filter(places, lambda i: (i == 0) | (F.get(points, i)["dt"] != F.get(points, i - 1)["dt"]))

        def cut(starts: Column) -> Column:
            return F.transform(
                starts, lambda b, j: F.slice(points, b + 1, F.coalesce(F.get(starts, j + 1), F.size(points)) - b)
            )

        return bound(begins, cut)

    days = bound(bound(F.col("_all"), last_of_day), by_day)
    daily = every.select(*DOCUMENT, F.explode(days).alias("_day"))

    pairs = F.transform("_day", lambda p: F.struct(p["metric"], p["value"]))
    picked = daily.select("asin", "site", "_ingested_at", F.col("_day")[0]["dt"].alias("dt"), F.map_from_entries(pairs).alias("_last"))

    def value(number: int, m: str) -> Column:
        text = F.try_element_at("_last", F.lit(number))
        found = text if m == "buybox_seller" else text.try_cast("double")
        return (found / SCALES[m] if SCALES.get(m, 1) != 1 else found).alias(m)

    return picked.select(
        "asin", "site", "dt", *[value(k, m) for k, m in enumerate(METRICS)], F.lit(SOURCE_TAG).alias("_source"), "_ingested_at"
    )


def review_rows(products: DataFrame) -> DataFrame:
    """One row per review; the day comes from its epoch seconds."""
    review = products.select("asin", "site", F.explode("reviews").alias("r"))
    return review.select(
        "asin",
        "site",
        F.coalesce(F.nullif("r.reviewId", F.lit("")), F.col("r.id")).alias("review_id"),
        F.to_date(F.timestamp_seconds("r.timestamp")).alias("dt"),
        F.col("r.rating").alias("rating"),
        F.col("r.title").alias("title"),
        F.col("r.text").alias("text"),
        F.col("r.verified").alias("verified"),
        F.lit(SOURCE_TAG).alias("_source"),
    )


def keyword_rows(products: DataFrame) -> DataFrame:
    """One row per keyword with its search metrics."""
    keyword = products.select("asin", "site", F.explode("keywords").alias("k"))
    return keyword.select(
        "asin",
        "site",
        F.coalesce(F.nullif("k.keyword", F.lit("")), F.col("k.term")).alias("keyword"),
        F.col("k.searchVolume").alias("est_search_volume"),
        F.col("k.cpc").alias("cpc"),
        F.col("k.difficulty").alias("difficulty"),
        F.lit(SOURCE_TAG).alias("_source"),
    )


@dataclass
class ProductTables:
    """Lazy tables normalised from product documents."""

    dim_asin: DataFrame
    timeseries: DataFrame
    reviews: DataFrame
    keywords: DataFrame
    raw: DataFrame


def normalise_products(landed: DataFrame, payload: str = "payload") -> ProductTables:
    """Fan one column of JSON documents out into the warehouse tables."""
    products = parse_products(landed, payload)
    return ProductTables(
        dim_rows(products),
        timeseries_rows(products),
        review_rows(products),
        keyword_rows(products),
        products.select("asin", "site", "raw"),
    )


def failed_ids(responses: DataFrame) -> DataFrame:
    """Distinct (asin, site) a response reports as not found or as an error.

    Responses carry `site`, `asinNotFound` (array) and `asinError` (map).
    """
    parts = []
    if "asinNotFound" in responses.columns:
        parts.append(responses.select("site", F.explode("asinNotFound").alias("asin")))
    if "asinError" in responses.columns:
        parts.append(responses.select("site", F.explode(F.map_keys("asinError")).alias("asin")))
    if not parts:
        return responses.select("site", F.lit(None).cast("string").alias("asin")).limit(0)
    found = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return found.select("asin", "site").distinct()


def split_dead_letters(requested: DataFrame, responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, dead) split of the requested (asin, site) ids."""
    failed = failed_ids(responses)
    dead = requested.join(failed, ["asin", "site"], "left_semi").withColumn("reason", F.lit(FETCH_FAILED))
    return requested.join(failed, ["asin", "site"], "left_anti"), dead


def tag_rows(df: DataFrame, **values: str) -> DataFrame:
    """Attach constant identifiers (asin, seller_id, site) to passed-through records."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def explode_tagged(df: DataFrame, items: str, keep: tuple[str, ...]) -> DataFrame:
    """One row per element of a nested record list (variations, deals), keeping the tags."""
    return df.select(*keep, F.explode(items).alias("item")).select(*keep, "item.*")
