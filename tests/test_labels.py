import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfsight.operators.asof import asof_join
from shelfsight.operators.labels import (
    add_group_id,
    assign_splits,
    attach_facts,
    build_labels,
    derive_targets,
    sample_windows,
)
from shelfsight.settings import LabelThresholds


def day(n):
    return dt.date(2021, 1, n)


def mart(spark, rows, columns="sales double, bsr_percentile double, bsr_rank double"):
    return spark.createDataFrame(rows, f"asin string, site string, dt date, {columns}")


def frame(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def run(spark, rows, columns, windows, limits=None, **options):
    result = build_labels(mart(spark, rows, columns), span=windows, thresholds=limits, **options)
    return result, result.samples.orderBy("t_ref", "site", "asin").collect()


def test_sparse_days(spark):
    rows = [
        ("A", "US", day(1), 5.0, 0.6, None),
        ("A", "US", day(3), 7.0, 0.55, None),
        ("A", "US", day(4), 4.0, 0.5, None),
        ("A", "US", day(6), 8.0, 0.35, None),
    ]
    result, out = run(spark, rows, "sales double, bsr_percentile double, bsr_rank double", (3, 2), LabelThresholds(1.0, 0.1, 50))
    assert [str(r["t_ref"]) for r in out] == ["2021-01-03", "2021-01-04"]
    first, second = out
    assert (first["past_sales"], first["future_sales"]) == (12.0, 4.0)
    assert first["past_coverage"] == pytest.approx(2 / 3) and first["future_coverage"] == 0.5
    assert first["sales_ratio"] == pytest.approx(4 / 12) and first["y_bin"] == 0
    assert second["sales_ratio"] == pytest.approx(8 / 11)
    assert second["bsr_percentile_drop"] == pytest.approx(0.525 - 0.35)
    assert second["past_mean_sales"] == 5.5 and second["past_std_sales"] == pytest.approx(1.5)
    assert all(r["site_mean_y_reg"] == r["split_mean_y_reg"] for r in out if r["split"] == "train")
    assert {r["split"] for r in result.train_samples_reg.collect()} == {"train"}


def test_equal_sales_have_zero_spread(spark):
    rows = [("A", "US", day(n), 0.1, None, None) for n in range(1, 12)]
    out = sample_windows(mart(spark, rows), (7, 1)).collect()
    assert out and all(r["past_std_sales"] == pytest.approx(0.0, abs=1e-12) for r in out)


def test_several_rows_a_day(spark):
    rows = [("A", "US", day(1), 1.0, None, None), ("A", "US", day(1), 5.0, None, None), ("A", "US", day(2), None, None, None)]
    out = sample_windows(mart(spark, rows), (1, 1)).collect()
    assert len(out) == 1
    assert out[0]["past_sales"] == 6.0 and out[0]["past_coverage"] == 1.0
    assert out[0]["past_std_sales"] == pytest.approx(2.0)
    assert out[0]["future_sales"] == 0.0 and out[0]["future_mean_sales"] is None


def test_no_samples(spark):
    result, out = run(spark, [("A", "US", day(1), 1.0, None, None)], "sales double, bsr_percentile double, bsr_rank double", (28, 30))
    assert out == [] and result.reports["balance"].count() == 0
    with pytest.raises(KeyError):
        sample_windows(mart(spark, []).drop("site"))


def test_group_ids_separate_sites(spark):
    rows = [(f"{s}_{p}", s, day(n), float(n), None, None) for s in ("US", "UK") for p in "AB" for n in (1, 2)]
    facts = frame(spark, [(f"{s}_{p}", s, "c1", "mid") for s in ("US", "UK") for p in "AB"], "asin string, site string, category_id string, price_band string")
    _, out = run(spark, rows, "sales double, bsr_percentile double, bsr_rank double", (1, 1), facts=facts)
    assert {r["group_id"] for r in out} == {"US|c1|mid", "UK|c1|mid"}
    assert {r["y_rank"] for r in out} == {0.75}


def test_price_band_only_if_any_row_has_one(spark):
    none = frame(spark, [("US", "c", None), ("UK", None, None)], "site string, category_id string, price_band string")
    assert {r["group_id"] for r in add_group_id(none).collect()} == {"US|c", "UK|unknown_category"}
    some = none.unionByName(frame(spark, [(None, "c", "low")], "site string, category_id string, price_band string"))
    assert {r["group_id"] for r in add_group_id(some).collect()} == {
        "US|c|unknown_price_band",
        "UK|unknown_category|unknown_price_band",
        "unknown_site|c|low",
    }


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_ties_share_rank(spark, hot_rows):
    rows = [("A", "US", day(1), 1.0, 200.0), ("A", "US", day(2), 5.0, 150.0), ("B", "US", day(1), 2.0, 220.0), ("B", "US", day(2), 5.0, 150.0)]
    samples = sample_windows(mart(spark, rows, "sales double, bsr_rank double"), (1, 1))
    out = derive_targets(samples, hot_rows=hot_rows).collect()
    assert [r["y_rank"] for r in out] == [0.75, 0.75]


@pytest.mark.parametrize(
    "rows, columns, windows, limits, ratio, y_bin",
    [
        # A rank gain alone confirms growth.
        ([(0.0, 500.0), (2.0, 400.0), (6.0, 200.0)], "sales double, bsr_rank double", (2, 1), (0.5, 0.2, 150), 3.0, 1),
        # Growth without any BSR signal is not positive.
        ([(10.0, 0.4, 100.0), (10.0, 0.4, 100.0), (40.0, 0.4, 100.0)], "sales double, bsr_percentile double, bsr_rank double", (2, 1), None, 2.0, 0),
        # Nothing to nothing is neutral.
        ([(0.0, 300.0), (0.0, 200.0), (0.0, 100.0)], "sales double, bsr_rank double", (2, 1), None, None, 1),
        ([(0.0, 0.9), (0.0, 0.8)], "sales double, bsr_percentile double", (1, 1), (0.1, 0.05, 10), None, 1),
        # Growth from nothing is infinite.
        ([(0.0, 0.9), (3.0, 0.1)], "sales double, bsr_percentile double", (1, 1), None, float("inf"), 1),
        # No BSR columns at all.
        ([(1.0,), (1.0,), (10.0,)], "sales double", (2, 1), (1.5, 0.1, 20), 5.0, 0),
    ],
)
def test_binary_target(spark, rows, columns, windows, limits, ratio, y_bin):
    data = [("A", "US", day(n + 1), *values) for n, values in enumerate(rows)]
    samples = sample_windows(mart(spark, data, columns), windows)
    out = derive_targets(samples, LabelThresholds(*limits) if limits else None).collect()
    assert len(out) == 1
    assert out[0]["sales_ratio"] == ratio and out[0]["y_bin"] == y_bin


def test_features_do_not_leak(spark):
    rows = [("A", "US", day(n), 1.0) for n in (1, 2, 3)]
    feats = frame(spark, [("A", "US", day(1), 10.0), ("A", "US", day(3), 99.0)], "asin string, site string, dt date, feat double")
    result, out = run(spark, rows, "sales double", (1, 1), features=feats)
    assert [r["feature_vector"] for r in out] == [{"feat": 10.0}, {"feat": 10.0}]


def test_mixed_facts_become_json_and_clash(spark):
    samples = frame(spark, [("A", "US", 1.0)], "asin string, site string, past_sales double")
    facts = frame(spark, [("A", "US", "c", None, 9.0)], "asin string, site string, category_id string, band string, past_sales double")
    found = attach_facts(samples, facts).first()
    assert found["past_sales_fact"] == 9.0
    assert found["metadata"] == '{"category_id":"c","past_sales":1.0}'


@pytest.mark.parametrize("by", [["k"], ["k", "n"]])
def test_asof_across_slices(spark, by):
    # One key holds most rows; long stretches without a right row cross slices.
    left = spark.range(400).select(F.lit("hot").alias("k"), F.lit(None).cast("string").alias("n"), (F.col("id") * 3).cast("int").alias("t"))
    left = left.unionByName(spark.createDataFrame([("cold", None, 50)], left.schema))
    times = [(0, 5.0), (200, None), (201, 7.0), (900, 9.0)]
    right = spark.createDataFrame([("hot", None, t, v) for t, v in times], "k string, n string, at int, a double")
    right = right.drop(*[c for c in ("k", "n") if c not in by])
    plain = asof_join(left, right, by, "t", "at").select("k", "t", "a")
    cut = asof_join(left, right, by, "t", "at", hot_rows=40).select("k", "t", "a")
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))
    if by == ["k"]:
        found = {r["t"]: r["a"] for r in cut.where("k = 'hot'").collect()}
        assert (found[0], found[198], found[201], found[897], found[1197]) == (5.0, 5.0, 7.0, 7.0, 9.0)


def test_asof_takes_whole_rows(spark):
    left = frame(spark, [("k", 5, "x"), ("k", 5, "y"), ("k", 1, "z"), ("m", 9, "w")], "k string, t int, tag string")
    right = frame(spark, [("k", 2, 1.0, 1.0), ("k", 4, None, 2.0), ("k", 6, 3.0, 3.0)], "k string, at int, a double, b double")
    found = {r["tag"]: (r["a"], r["b"]) for r in asof_join(left, right, ["k"], "t", "at").collect()}
    assert found == {"x": (None, 2.0), "y": (None, 2.0), "z": (None, None), "w": (None, None)}
    once = asof_join(left.where("tag <> 'y'"), right, ["k"], "t", "at", unique_left=True)
    assert {r["tag"]: r["b"] for r in once.collect()} == {"x": 2.0, "z": None, "w": None}


@pytest.mark.parametrize(
    "count, ratios, expected",
    [
        (10, (0.7, 0.15, 0.15), [8, 1, 1]),
        (3, (0.7, 0.15, 0.15), [3, 0, 0]),
        (20, (0.5, 0.25, 0.25), [10, 5, 5]),
        (1, (0.7, 0.15, 0.15), [1, 0, 0]),
        (2, (0.0, 0.5, 0.5), [1, 0, 1]),
    ],
)
def test_time_splits(spark, count, ratios, expected):
    rows = frame(spark, [(day(n + 1),) for n in range(count)], "t_ref date")
    found = {r["split"]: r["count"] for r in assign_splits(rows, dict(zip(("train", "valid", "test"), ratios))).groupBy("split").count().collect()}
    assert [found.get(s, 0) for s in ("train", "valid", "test")] == expected


def test_reports(spark):
    rows = [("A", "US", day(n), float(n), 0.1, None) for n in range(1, 13)]
    seen = []
    result, out = run(
        spark, rows, "sales double, bsr_percentile double, bsr_rank double", (2, 1),
        report_callback=lambda name, _: seen.append(name),
    )
    assert set(seen) == set(result.reports)
    assert sum(r["count"] for r in result.reports["balance"].collect()) == len(out)
    missing = {r["column"]: r["missing_fraction"] for r in result.reports["missingness"].collect()}
    assert missing["past_bsr_rank"] == 1.0 and missing["y_reg"] == 0.0
    share = result.reports["bsr_availability"].agg(F.max("past_bsr_percentile")).first()[0]
    assert share == 1.0
