import datetime as dt
import json
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from checks.queries import QUERIES, _scoring_input
from shelfsight.operators.features import add_listing_quality, build_features
from shelfsight.operators.scoring import score
from shelfsight.settings import SCORE_WEIGHTS

DAY = dt.date(2024, 1, 1)


def panel(spark, rows):
    return spark.createDataFrame(
        rows,
        "asin string, site string, dt date, bsr double, price double, rating double,"
        " reviews_count bigint, est_sales double",
    )


def random_panel(n, seed=1):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        bsr = None if draw.random() < 0.05 else (0.0 if draw.random() < 0.03 else draw.uniform(1, 90))
        price = None if draw.random() < 0.1 else draw.uniform(5, 9)
        rating = None if draw.random() < 0.4 else draw.uniform(1, 5)
        rows.append(("A", "US", DAY + dt.timedelta(days=i + i // 9), bsr, price, rating, i * i, draw.uniform(0, 3)))
    return rows


def expected_features(rows):
    frame = pd.DataFrame(rows, columns=["asin", "site", "dt", "bsr", "price", "rating", "reviews", "sales"])
    inverse = frame["bsr"].map(lambda v: None if not v or pd.isna(v) else 1 / v).astype(float)
    out = {}
    for n in (7, 14, 30):
        need = math.ceil(0.7 * n)

        def slope(values):
            if values.isna().any():
                return math.nan
            x = pd.Series(range(len(values)), dtype=float)
            y = values.reset_index(drop=True)
            return ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()

        out[f"bsr_trend_{n}"] = inverse.rolling(n, min_periods=need).apply(slope, raw=False)
        price = frame["price"].rolling(n, min_periods=need)
        out[f"price_vol_{n}"] = price.std() / price.mean()
        out[f"rating_mean_{n}"] = frame["rating"].rolling(n, min_periods=need).mean()
    out["review_vel_14"] = frame["reviews"].diff(14)
    out["est_sales_30"] = frame["sales"].rolling(30, min_periods=21).mean()
    return pd.DataFrame(out)


@pytest.mark.parametrize("options", [{}, {"daily": False, "block_rows": 32, "hot_rows": 10}])
def test_rolling_features_match_brute_force(spark, options):
    rows = random_panel(150)
    found = build_features(panel(spark, rows), **options).orderBy("dt").toPandas()
    wanted = expected_features(rows)
    assert len(found) == len(rows)
    for name in wanted:
        mine, theirs = found[name].astype(float), wanted[name].astype(float)
        assert mine.isna().tolist() == theirs.isna().tolist(), name
        assert mine.dropna().tolist() == pytest.approx(theirs.dropna().tolist(), rel=1e-9), name


def test_single_row_window_has_flat_trend(spark):
    rows = [("A", "US", DAY, 5.0, 1.0, 1.0, 1, 1.0)]
    assert build_features(panel(spark, rows), rolling=(1,)).first()["bsr_trend_1"] == 0.0


def test_missing_optional_columns(spark):
    rows = spark.createDataFrame([("A", "US", DAY, 5.0)], "asin string, site string, dt date, price double")
    found = build_features(rows).first()
    assert found["est_sales_30"] is None and found["listing_quality"] is None


def test_listing_quality_parts(spark):
    rows = spark.createDataFrame(
        [(1, 80.0, 6.0, 7.0, True, True, True, True), (2, 40.0, 3.0, 3.5, True, False, False, False), (3, None, 9.0, 9.0, None, None, None, None)],
        "id int, title_length double, bullet_count double, image_count double, has_material_attr boolean,"
        " has_size_attr boolean, has_use_case_attr boolean, has_a_plus boolean",
    )
    found = {r["id"]: r["listing_quality"] for r in add_listing_quality(rows).collect()}
    assert found[1] == pytest.approx(1.0)
    assert found[2] == pytest.approx(0.25 * (0.5 + 0.5 + 0.5 + (1 / 3) / 2))
    assert found[3] is None


METRICS = "bsr_trend_30 double, est_sales_30 double, review_vel_14 double, price_vol_30 double, listing_quality double"


def scored_rows(spark, rows):
    return spark.createDataFrame(rows, f"asin string, site string, dt date, category string, {METRICS}")


def test_score_by_hand(spark):
    rows = [
        ("A", "US", DAY, "c", 1.0, 10.0, 5.0, 0.2, 0.5),
        ("B", "US", DAY, "c", 3.0, 10.0, 7.0, 0.4, 0.5),
        ("C", "US", DAY, "c", 8.0, 10.0, 6.0, 0.8, 0.9),
    ]
    out = {r["asin"]: r for r in score(scored_rows(spark, rows)).collect()}
    # Medians 3, 10, 6, 0.4, 0.5; spreads 2, 0 -> 1e-9, 1, 0.2, 0 -> 1e-9.
    assert out["A"]["explosive_score"] == pytest.approx(0.35 * -1 + 0 + 0.2 * -1 + 0.1 * -1)
    assert out["B"]["explosive_score"] == pytest.approx(0.2)
    assert out["C"]["explosive_score"] == pytest.approx(0.35 * 2.5 + 0.1 * 2 + 0.3 * 0.4 / 1e-9)
    assert [out[a]["rank_in_cat"] for a in "CBA"] == [1, 2, 3]
    reason = json.loads(out["A"]["reason"])
    assert reason["w"]["price_vol_30"] == -0.1 and reason["z"]["bsr_trend_30"] == -1.0


def test_null_groups_and_missing_scores(spark):
    rows = [
        ("A", None, DAY, None, 1.0, 1.0, 1.0, 1.0, 1.0),
        ("B", None, DAY, None, 2.0, 2.0, 2.0, 2.0, 2.0),
        ("C", None, DAY, None, None, 2.0, 2.0, 2.0, 2.0),
    ]
    out = {r["asin"]: r for r in score(scored_rows(spark, rows)).collect()}
    assert out["C"]["explosive_score"] is None and out["C"]["rank_in_cat"] is None
    assert {out["A"]["rank_in_cat"], out["B"]["rank_in_cat"]} == {1, 2}


def test_rank_cutoff(spark):
    rows = [(f"P{i}", "US", DAY, "c", float(i), 1.0, 1.0, 1.0, 1.0) for i in range(30)]
    out = score(scored_rows(spark, rows), rank_min=5).where("rank_in_cat IS NOT NULL")
    assert sorted(r["rank_in_cat"] for r in out.collect()) == [1, 2, 3, 4, 5]


def test_the_reason_query_parses_a_text_once(spark, tmp_path):
    lines = [(k, 1 + k % 40, 1 + k % 3, 1 + k % 4, 5.0 + k % 7, 10.0 + k, 0.05, 0.01 * (k % 5), "R", "O", dt.datetime(2020, 1, 1 + k % 28)) for k in range(300)]
    columns = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    suppliers = [(k, f"s{k}", 7 if k == 3 else 1, 100.0) for k in (1, 2, 3)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    spark.createDataFrame([(1, "one"), (7, "seven")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    found = QUERIES["score_reason"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") + plan.count("get_json_object(") == 1
    full = score(_scoring_input(spark, str(tmp_path)), keep_z=True)
    want = {(r["asin"], str(r["dt"])): r["z_listing_quality"] for r in full.collect()}
    rows = found.collect()
    assert len(rows) == len(want) and {r["weight"] for r in rows} == {0.3}
    for r in rows:
        z = want[r["asin"], r["dt"]]
        assert r["z"] is None if z is None else r["z"] == pytest.approx(z, abs=1e-6)


def test_the_reason_text_writes_its_weights_once(spark):
    rows = [
        ("A", "US", DAY, "c", 1.0, None, 5.0, float("inf"), 0.5),
        ("B", "US", DAY, "c", 3.0, None, 7.0, 0.4, float("nan")),
        ("C", "US", DAY, "c", 8.0, None, 6.0, 0.8, 0.9),
        ("D", "UK", DAY, None, None, None, None, None, None),
    ]
    out = score(scored_rows(spark, rows), keep_z=True)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert '{"bsr_trend_30":0.35,' in plan
    metrics = list(SCORE_WEIGHTS)
    both = F.struct(
        F.struct(*[F.lit(w).alias(m) for m, w in SCORE_WEIGHTS.items()]).alias("w"),
        F.struct(*[F.col(f"z_{m}").alias(m) for m in metrics]).alias("z"),
    )
    texts = {r["asin"]: (r["reason"], r["whole"]) for r in out.withColumn("whole", F.to_json(both)).collect()}
    assert len(texts) == 4 and all(a == b for a, b in texts.values())
    assert texts["D"][0].endswith('"z":{}}')


def test_the_reason_query_passes_over_other_entries(spark, tmp_path):
    lines = [(k, 1, 1, 1, 5.0, 10.0, 0.05, 0.01, "R", "O", dt.datetime(2020, 1, 1 + k)) for k in range(9)]
    columns = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "s", 1, 1.0)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double").write.parquet(
        str(tmp_path / "supplier.parquet")
    )
    spark.createDataFrame([(1, "one")], "n_nationkey int, n_name string").write.parquet(str(tmp_path / "nation.parquet"))
    found = QUERIES["score_reason"](spark, str(tmp_path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapType" not in plan.split("from_json(")[1].split("to_json")[0].split("concat(")[0]
    assert [(r["weight"], r["z"]) for r in found.collect()] == [(0.3, 0.0)] * 9
