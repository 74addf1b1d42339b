import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import inference, running
from shelfsight.operators.standardize import standardize
from shelfsight.settings import ScoringSettings
from shelfsight.sources import datasets, payload, vendors
from shelfsight.sources.scratch import materialize, scratch_path
from shelfsight.streaming.incremental import DAY_FILES, merge_batch, read_mart, stream_raw

BASE = dt.datetime(2023, 1, 1, tzinfo=dt.timezone.utc)


def ts(days):
    return int((BASE + dt.timedelta(days=days)).timestamp())


def product(**changes):
    body = {
        "asin": "B0001",
        "domainId": 1,
        "title": "Enamel kettle, 2 l",
        "brand": "Hearthline",
        "categoryTree": [{"name": "Kitchen"}, {"name": ""}, {"id": 4}, {"name": "Kettles"}],
        "imagesCSV": "https://example.com/a.jpg,,https://example.com/b.jpg",
        "history": {
            "salesRanks": {"default": [{"timestamp": ts(0), "value": 2710}, {"timestamp": ts(1), "value": 2645}], "x": []},
            "buyBoxPrice": [{"timestamp": ts(0), "value": 3450}, {"timestamp": ts(1), "value": 3275}],
            "rating": [{"timestamp": ts(0), "value": 430}],
            "reviewCount": [{"timestamp": ts(0), "value": 87}, {"timestamp": ts(1), "value": 91}],
            "stock": [{"timestamp": ts(0), "value": 14}],
            "buyBoxSeller": [{"timestamp": ts(0), "value": "KettleHut"}],
        },
        "reviews": [{"reviewId": "R1", "timestamp": ts(0), "rating": 5, "title": "Boils fast", "text": "No drip so far", "verified": True}],
        "keywords": [{"keyword": "stove kettle", "searchVolume": 8300, "cpc": 0.9, "difficulty": 0.35}],
    }
    return body | changes


def land(spark, *bodies):
    stamp = dt.datetime(2024, 1, 1)
    rows = [(json.dumps(b), stamp + dt.timedelta(hours=i)) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "payload string, _ingested_at timestamp")


def panel(spark, **changes):
    found = payload.normalise_products(land(spark, product(**changes))).timeseries
    return {str(r["dt"]): r for r in found.collect()}


def test_product_tables(spark):
    tables = payload.normalise_products(land(spark, product()))
    dim = tables.dim_asin.first()
    assert dim["site"] == "US" and dim["category_path"] == ["Kitchen", "Kettles"] and len(dim["images"]) == 2
    rows = tables.timeseries.orderBy("dt").collect()
    assert len(rows) == 2 and rows[0]["_source"] == "keepa"
    first = rows[0]
    assert (first["price"], first["bsr"], first["reviews_count"]) == (34.5, 2710.0, 87.0)
    assert (first["rating"], first["stock_est"], first["buybox_seller"]) == (4.3, 14.0, "KettleHut")
    assert rows[1]["rating"] is None and rows[1]["price"] == 32.75
    review = tables.reviews.first()
    assert (review["review_id"], str(review["dt"]), review["verified"]) == ("R1", "2023-01-01", True)
    assert tables.keywords.first()["est_search_volume"] == 8300
    assert json.loads(tables.raw.first()["raw"])["asin"] == "B0001"


def test_flat_encoding_sums_minutes(spark):
    day = 1440
    found = panel(spark, history={"reviewCount": [day * 10, 5, day, 6, 30, 7, day * 2, 8, 99], "rating": [day * 10, 412.5]})
    assert {d: r["reviews_count"] for d, r in found.items()} == {"1970-01-11": 5.0, "1970-01-12": 7.0, "1970-01-14": 8.0}
    assert found["1970-01-11"]["rating"] == pytest.approx(4.125)


def test_last_point_in_array_order_wins(spark):
    found = panel(spark, history={"stock": [{"time": ts(0) + 900, "value": 1}, {"dt": ts(0), "value": 2}, {"timestamp": ts(0) + 5, "value": None}, {"value": 9}]})
    assert [r["stock_est"] for r in found.values()] == [2.0]


@pytest.mark.parametrize(
    "history, price",
    [
        ({"newPrice": [{"timestamp": 0, "value": 500}], "new": [{"timestamp": 0, "value": 100}]}, [5.0]),
        # The first key present decides, even when its series is null.
        ({"buyBoxPrice": None, "newPrice": [{"timestamp": 0, "value": 500}]}, []),
        ({"buyBoxSalePrice": [{"timestamp": 0, "value": 700}]}, [7.0]),
        ({}, []),
    ],
)
def test_price_series_choice(spark, history, price):
    assert [r["price"] for r in panel(spark, history=history).values()] == price


@pytest.mark.parametrize(
    "history, bsr",
    [
        ({"salesRanks": {}, "salesRank": {"a": [{"timestamp": 0, "value": 3}]}}, [3.0]),
        ({"salesRanks": None, "salesRank": {"a": [{"timestamp": 0, "value": 4}]}}, [4.0]),
        ({"salesRanks": [{"timestamp": 0, "value": 3}]}, []),
        ({"salesRanks": {"a": [1440, 8]}}, [8.0]),
    ],
)
def test_sales_rank_choice(spark, history, bsr):
    assert [r["bsr"] for r in panel(spark, history=history).values()] == bsr


def test_documents_stay_apart_and_sites_default(spark):
    landed = land(spark, product(domainId=2), product(domainId=2), product(domainId=77, history=None, keywords=None, reviews=None, categoryTree=None, imagesCSV=None))
    tables = payload.normalise_products(landed)
    assert tables.timeseries.groupBy("site").count().collect()[0][:] == ("UK", 4)
    assert sorted(r["site"] for r in tables.dim_asin.collect()) == ["UK", "UK", "US"]


def test_two_documents_of_one_arrival(spark):
    point = lambda v: {"stock": [{"timestamp": str(ts(0)), "value": v}]}
    landed = land(spark, product(history=point(1)), product(history=point(2))).drop("_ingested_at")
    rows = payload.normalise_products(landed).timeseries.collect()
    assert sorted(r["stock_est"] for r in rows) == [1.0, 2.0]


def test_fallback_ids(spark):
    body = product(reviews=[{"reviewId": "", "id": "X"}], keywords=[{"keyword": None, "term": "t"}])
    tables = payload.normalise_products(land(spark, body))
    assert tables.reviews.first()["review_id"] == "X" and tables.reviews.first()["dt"] is None
    assert tables.keywords.first()["keyword"] == "t"


def test_dead_letters(spark):
    asked = spark.createDataFrame([("B0001", "US"), ("B0002", "US"), ("B0003", "US")], "asin string, site string")
    responses = spark.createDataFrame([("US", ["B0002"], {"B0003": "E"})], "site string, asinNotFound array<string>, asinError map<string,string>")
    good, dead = payload.split_dead_letters(asked, responses)
    assert [r["asin"] for r in good.collect()] == ["B0001"]
    assert {(r["asin"], r["reason"]) for r in dead.collect()} == {("B0002", "keepa_fetch_failed"), ("B0003", "keepa_fetch_failed")}


def test_tagging(spark):
    deals = spark.createDataFrame([([("d1", 5), ("d2", 6)],)], "deals array<struct<id:string,off:int>>")
    rows = payload.explode_tagged(payload.tag_rows(deals, site="US"), "deals", ("site",))
    assert [tuple(r) for r in rows.orderBy("id").collect()] == [("US", "d1", 5), ("US", "d2", 6)]


def parsed(spark, schema, *bodies):
    rows = spark.createDataFrame([(json.dumps(b),) for b in bodies], "j string")
    return rows.select(F.from_json("j", schema).alias("x")).select("x.*")


def test_vendor_mappings(spark):
    order = {"AmazonOrderId": "o1", "MarketplaceId": "US", "PurchaseDate": "2024-01-01", "OrderTotal": {"CurrencyCode": "USD", "Amount": "9.5"}, "OrderItems": [{"ASIN": "a", "QuantityOrdered": 2}, {"ASIN": "b", "QuantityShipped": 1}]}
    found = vendors.order_items(parsed(spark, vendors.ORDERS_SCHEMA, order, {"AmazonOrderId": "o2"})).collect()
    assert [(r["asin"], r["ordered_units"], r["gross_sales"]) for r in found] == [("a", 2, "9.5"), ("b", None, "9.5")]
    stock = vendors.inventory_rows(parsed(spark, vendors.INVENTORY_SCHEMA, {"asin": "a", "inventoryDetails": {"fulfillableQuantity": 3}}), "US").first()
    assert (stock["fulfillable_quantity"], stock["inbound_working"]) == (3, None)
    item = {"ASIN": "a", "ItemInfo": {"Title": {"DisplayValue": "T"}}, "BrowseNodeInfo": {"BrowseNodes": [{"DisplayValue": "N"}, {}]}, "Images": {"Primary": {"Small": {"URL": "u"}, "Large": {}}}}
    row = vendors.catalogue_items(parsed(spark, vendors.ITEM_SCHEMA, item), "US").first()
    assert (row["title"], row["brand"], row["category_path"], row["images"]) == ("T", None, ["N"], ["u"])
    feed = parsed(spark, vendors.KEYWORD_SCHEMA, {"keyword": "k", "search_volume": 4})
    both = vendors.all_keyword_metrics(dict.fromkeys(vendors.KEYWORD_SOURCES, feed), "US").collect()
    assert {r["_source"] for r in both} == {"junglescout", "helium10"}
    ads = vendors.ads_metrics(parsed(spark, vendors.ADS_SCHEMA, {"marketplaceId": "US", "clicks": 3}), "p").first()
    assert (ads["profile_id"], ads["site"], ads["clicks"], ads["spend"]) == ("p", "US", 3, None)


def test_landing_and_reading_one_kind(spark):
    root = scratch_path(spark, "land")
    rows = [("a", "{}", dt.datetime(2024, 1, 1, 0, 0, 0, 123456), "US", "core"), ("b", "{}", None, "UK", "reviews")]
    datasets.land_payloads(spark.createDataFrame(rows, "asin string, payload string, _ingested_at timestamp, site string, kind string"), root)
    found = datasets.read_landed(spark, root, "core").collect()
    assert [(r["asin"], r["_ingested_at"].microsecond) for r in found] == [("a", 123456)]


def test_dataset_folder(spark):
    root = scratch_path(spark, "set")
    spark.range(3).write.parquet(root)
    spark.range(3, 5).write.mode("append").option("header", True).csv(root)
    spark.range(90, 95).write.mode("append").json(root)
    assert sorted(r["id"] for r in datasets.load_dataset(spark, root, "id bigint").collect()) == [0, 1, 2, 3, 4]
    assert datasets.load_dataset(spark, root).count() == 5
    other = scratch_path(spark, "json")
    spark.range(2).write.json(other)
    with pytest.raises(FileNotFoundError):
        datasets.load_dataset(spark, other)


def test_snapshots(spark):
    root = scratch_path(spark, "snap")
    for day, n in ((1, 1), (5, 2), (9, 3), (5, 4)):
        datasets.write_snapshot(spark.range(n), root, dt.date(2024, 1, day))
    rows, found = datasets.load_latest(spark, root, dt.date(2024, 1, 8))
    assert found == dt.date(2024, 1, 5) and rows.count() == 4 and rows.columns == ["id"]
    assert datasets.load_latest(spark, root)[1] == dt.date(2024, 1, 9)
    assert datasets.load_latest(spark, root, dt.date(2023, 1, 1)) == (None, None)
    assert "snapshot_date" not in rows._jdf.queryExecution().toString().replace("snapshot_date=", "")


def test_a_first_run_has_no_snapshots(spark, tmp_path):
    assert datasets.load_latest(spark, str(tmp_path / "absent")) == (None, None)
    assert datasets.load_latest(spark, str(tmp_path)) == (None, None)
    (tmp_path / "notes.csv").write_text("a\n1\n")
    assert datasets.load_latest(spark, str(tmp_path)) == (None, None)
    run = inference.run_batch(spark, str(tmp_path / "absent"), {}, SCORER, as_of=dt.date(2024, 1, 3))
    assert run.items is None and run.run_date == dt.date(2024, 1, 3)


def test_text_snapshots(spark, tmp_path):
    (tmp_path / "2024-01-02.csv").write_text("asin,x\nA,1.5\nB,\n")
    (tmp_path / "2024-01-04.json").write_text('{"asin": "C", "x": 2.5}\n')
    spark.range(3).write.parquet(str(tmp_path / "2024-01-06.parquet"))
    rows, found = datasets.load_latest(spark, str(tmp_path), dt.date(2024, 1, 3), "asin string, x double")
    assert found == dt.date(2024, 1, 2) and sorted(map(tuple, rows.collect())) == [("A", 1.5), ("B", None)]
    rows, found = datasets.load_latest(spark, str(tmp_path), dt.date(2024, 1, 5))
    assert found == dt.date(2024, 1, 4) and [tuple(r) for r in rows.select("asin", "x").collect()] == [("C", 2.5)]
    rows, found = datasets.load_latest(spark, str(tmp_path))
    assert found == dt.date(2024, 1, 6) and rows.count() == 3


def test_reports_are_one_file(spark, tmp_path):
    table = spark.createDataFrame([("ndcg@5", 0.5), ("map", 0.25)], "metric string, value double").repartition(2)
    for kind in ("csv", "json"):
        datasets.write_report(table, str(tmp_path / kind), kind)
        back = spark.read.option("header", True).format(kind).load(str(tmp_path / kind))
        assert {(r["metric"], float(r["value"])) for r in back.collect()} == {("ndcg@5", 0.5), ("map", 0.25)}
        assert len(list((tmp_path / kind).glob("part-*"))) == 1
    with pytest.raises(ValueError, match="csv"):
        datasets.write_report(table, str(tmp_path / "x"), "xlsx")


SCORER = inference.LinearScorer({"x": 2.0, "y": -3.0, "a": 1.0, "b": 0.5, "c": 0.1, "d": 0.01}, {"x": 1.0}, 10.0)
FEATURES = "asin string, site string, dt date, category string, price_band string, x double, y double, a double, b double, c double, d double"


def feature_rows(spark):
    day = dt.date(2024, 1, 1)
    rows = [
        ("A", "US", day, "c", "low", 3.0, 1.0, 1.0, 1.0, 1.0, 1.0),
        ("B", "US", day, "c", "low", 2.0, 0.0, 1.0, 1.0, 1.0, 1.0),
        ("C", "US", day, "c", None, None, 0.0, 1.0, 1.0, 1.0, 1.0),
    ]
    return spark.createDataFrame(rows, FEATURES)


@pytest.mark.parametrize("hot_rows", [2, 100])
def test_batch_scores(spark, hot_rows):
    found = {r["asin"]: r for r in inference.score_batch(feature_rows(spark), SCORER, hot_rows=hot_rows).collect()}
    assert found["A"]["lgbm_score"] == pytest.approx(10 + 6 - 3 + 1.61)
    assert found["C"]["lgbm_score"] == pytest.approx(12 + 1.61)
    assert list(json.loads(found["A"]["reason"])) == ["x", "y", "a", "b", "c"]
    assert (found["A"]["group_id"], found["C"]["group_id"]) == ("US|c|low", "US|c|UNKNOWN")
    assert [found[k]["rank_in_group"] for k in "ABC"] == [2, 1, 1]
    assert [found[k]["rank_in_cat"] for k in "ABC"] == [2, 1, 3]


def test_scores_and_texts_are_written_once_and_not_shuffled(spark, monkeypatch):
    day = dt.date(2024, 1, 1)
    rows = [(f"A{k}", "US", day, "c", f"band{k % 40}", float(k % 50), 1.0, 1.0, 1.0, 1.0, 1.0) for k in range(400)]
    features = spark.createDataFrame([*rows, ("N", None, None, None, None, *[None] * 6)], FEATURES)
    want = sorted(map(str, inference.score_batch(features, SCORER).collect()))
    plans = {}

    def recorded(df, label, *rest):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return materialize(df, label, *rest)

    monkeypatch.setattr(inference, "materialize", recorded)
    monkeypatch.setattr(inference, "spread_keys", lambda df, by, rows: running.spread_keys(df, by, rows, task_rows=20))
    out = inference.score_batch(features, SCORER)
    assert sorted(map(str, out.collect())) == want
    exchanges = [line for line in plans["scores"].splitlines() if "Exchange" in line]
    assert "rank_in_group" in plans["scores"] and len(exchanges) == 1
    before_the_exchange = plans["scores"].split("Exchange")[1]
    assert "lgbm_score" not in before_the_exchange and "Exchange hash" not in out._jdf.queryExecution().executedPlan().toString()


def test_missing_columns_score_nothing(spark):
    rows = feature_rows(spark)
    assert inference.score_batch(rows.drop("x"), SCORER).count() == 0
    assert inference.score_batch(rows.drop("price_band"), SCORER).count() == 0


def test_rank_cutoff_and_python_model(spark):
    def predict(frames):
        for frame in frames:
            yield frame.assign(lgbm_score=frame["y"] * 2, _contributions=[{"y": v} for v in frame["y"]])

    out = inference.score_batch(feature_rows(spark), inference.PandasScorer(predict, ["y"]), ScoringSettings(rank_min=1))
    found = {r["asin"]: r for r in out.collect()}
    assert [found[k]["rank_in_cat"] for k in "ABC"] == [1, None, None]
    assert json.loads(found["A"]["reason"]) == {"y": 1.0}


def test_batch_run_exports(spark):
    features, out, view = (scratch_path(spark, n) for n in ("f", "s", "v"))
    inference.store_features(feature_rows(spark), features, dt.date(2024, 1, 1))
    run = inference.run_batch(
        spark, features, {"scored_rows": out}, SCORER, as_of=dt.date(2024, 2, 1), feature_view=("feature_rows", view)
    )
    assert run.run_date == dt.date(2024, 1, 1) and run.score_artifacts == {"scored_rows": out}
    items = {r["asin"]: r for r in run.items.collect()}
    assert items["B"]["rank_in_group"] == 1 and items["A"]["reason"]["y"] == -3.0
    assert spark.sql("SELECT count(*) AS n FROM scored_rows").first()["n"] == 3
    assert spark.table("feature_rows").count() == 3
    late = inference.run_batch(spark, features, {}, SCORER, as_of=dt.date(2020, 1, 1))
    assert late.items is None and late.run_date == dt.date(2020, 1, 1)


def test_scored_item_fallbacks(spark):
    rows = spark.createDataFrame([("A", "US", None, 5.0, "not json")], "asin string, site string, dt string, lgbm_score double, reason string")
    item = inference.scored_items(rows, dt.date(2024, 1, 1)).first()
    assert (item["dt"], item["explosive_score"], item["reason"], item["rank_in_group"]) == (dt.date(2024, 1, 1), 5.0, {}, None)


def test_request_records(spark):
    rows = spark.createDataFrame([('{"asin":"A","site":"US","dt":"2024-01-02","est_sales_30":4,"vendor":"v"}',)], "item string")
    found = inference.request_records(rows).first()
    assert found["dt"] == dt.date(2024, 1, 2) and found["est_sales_30"] == 4.0 and found["extra"] == {"vendor": "v"}


def test_materialize_keeps_rows(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert sorted(map(tuple, materialize(df).collect())) == [(i, 2 * i) for i in range(10)]


def test_stream_keeps_the_last_delivery(spark):
    schema = "asin string, site string, dt string, price string, bsr string, rating string, reviews_count bigint, stock_est bigint, buybox_seller string, _ingested_at timestamp"

    def row(asin, day, price, hour):
        return (asin, "US", f"2024-01-0{day}", price, "5", "4", 1, 1, "s", dt.datetime(2024, 2, 1, hour))

    landed, target, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    batches = [
        [row("A", 1, "1", 5), row("A", 1, "2", 6), row("B", 2, "9", 1)],
        [row("A", 1, "3", 4), row("B", 2, "8", 2), row("C", 3, "7", 1)],
        [],
    ]
    everything = []
    for batch in batches:
        everything += batch
        spark.createDataFrame(batch, schema).write.mode("append").json(landed)
        parsed_schema = spark.createDataFrame([], schema).schema
        stream_raw(spark, landed, parsed_schema, target, checkpoint).awaitTermination()
    found = {(r["asin"], str(r["dt"])): r["price"] for r in read_mart(spark, target, parsed_schema).collect()}
    assert found == {("A", "2024-01-01"): 2.0, ("B", "2024-01-02"): 8.0, ("C", "2024-01-03"): 7.0}
    whole = standardize(spark.createDataFrame(everything, schema)).collect()
    assert {(r["asin"], str(r["dt"])): r["price"] for r in whole} == found


def test_a_redelivery_rewrites_only_changed_days(spark, tmp_path):
    schema = "asin string, site string, dt string, price string, bsr string, rating string, reviews_count bigint, stock_est bigint, buybox_seller string, _ingested_at timestamp"

    def rows(day, price, hour, n=50):
        stamp = dt.datetime(2024, 2, 1, hour)
        return [(f"A{k}", "US", day, price, "5", "4", 1, 1, None, stamp) for k in range(n)]

    def files():
        return {d.name: sorted(f.name for f in d.glob("*.parquet")) for d in target.glob("day=*")}

    target = tmp_path / "mart"
    first = rows("2024-01-01", "1", 1) + rows("2024-01-02", "1", 1) + rows("not a day", "1", 1)
    merge_batch(spark.createDataFrame(first, schema).repartition(16), str(target))
    before = files()
    assert len(before) == 3 and all(1 <= len(f) <= DAY_FILES for f in before.values())
    # The same rows again, and for one day a later price for one product.
    again = first + [("A7", "US", "2024-01-02", "2", "5", "4", 1, 1, None, dt.datetime(2024, 2, 2, 1))]
    merge_batch(spark.createDataFrame(again, schema).repartition(16), str(target))
    after = files()
    assert {d for d in after if after[d] != before[d]} == {"day=2024-01-02"}
    assert len(after["day=2024-01-02"]) <= DAY_FILES
    merge_batch(spark.createDataFrame(first, schema), str(target))
    assert files() == after
    kept = spark.read.parquet(str(target))
    assert kept.count() == 150 and [r["price"] for r in kept.where("asin = 'A7' and dt = '2024-01-02'").collect()] == ["2"]
