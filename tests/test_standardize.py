import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfsight.operators.quality import (
    anomaly_counts,
    date_coverage,
    missing_columns,
    reconcile_counts,
    validate_timeseries,
)
from shelfsight.operators.standardize import standardize, standardize_all, union_all

COLUMNS = (
    "asin string, site string, dt string, price string, bsr string, rating string,"
    " reviews_count bigint, stock_est bigint, buybox_seller string, _ingested_at timestamp"
)


def raw(spark, *rows):
    return spark.createDataFrame(rows, COLUMNS)


def row(asin, day, price, bsr, hour=0, rating="4.5"):
    stamp = None if hour is None else dt.datetime(2024, 1, 1, hour)
    return (asin, "US", day, price, bsr, rating, 10, 5, "s", stamp)


def test_latest_delivery_wins_and_flags_follow(spark):
    out = standardize(raw(spark, row("A", "2024-01-01", "-1", "10", 0), row("A", "2024-01-01", "20", "-5", 1)))
    found = out.collect()
    assert len(found) == 1
    assert found[0]["price"] == 20.0 and found[0]["price_valid"] is True
    assert found[0]["bsr"] is None and found[0]["bsr_valid"] is False
    assert found[0]["dt"] == dt.date(2024, 1, 1)


def test_unknown_arrival_counts_as_latest(spark):
    out = standardize(raw(spark, row("A", "2024-01-01", "1", "10", None), row("A", "2024-01-01", "2", "10", 9)))
    assert [r["price"] for r in out.collect()] == [1.0]


def test_bad_text_becomes_missing(spark):
    out = standardize(raw(spark, row("A", "2024-01-01", "5", "not-a-number"), row("A", "2024-01-02", "x", "100")))
    found = {str(r["dt"]): r for r in out.collect()}
    assert [found[d]["bsr_valid"] for d in sorted(found)] == [False, True]
    assert found["2024-01-02"]["price"] is None


def test_upper_bsr_limit_is_exclusive(spark):
    out = standardize(raw(spark, row("A", "2024-01-01", "5", "5000000"), row("B", "2024-01-01", "5", "4999999")))
    assert {r["asin"]: r["bsr_valid"] for r in out.collect()} == {"A": False, "B": True}


def test_dedup_on_raw_or_cut_day(spark):
    rows = raw(spark, row("A", "2024-01-01 08:00:00", "1", "1", 0), row("A", "2024-01-01 09:00:00", "2", "1", 1))
    assert standardize(rows).count() == 2
    assert [r["price"] for r in standardize(rows, dedup_on="date").collect()] == [2.0]
    with pytest.raises(ValueError):
        standardize(rows, dedup_on="week")


def test_frames_with_other_columns_combine(spark):
    a = raw(spark, row("A", "2024-01-01", "1", "1"))
    b = raw(spark, row("B", "2024-01-01", "1", "1")).drop("buybox_seller")
    assert {r["asin"]: r["buybox_seller"] for r in standardize_all([a, b]).collect()} == {"A": "s", "B": None}
    with pytest.raises(ValueError):
        union_all([])


def days(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "dt string").select(F.col("dt").cast("date").alias("dt"))


@pytest.mark.parametrize(
    "values, coverage",
    [
        (["2024-01-01", "2024-01-02", "2024-01-03"], 1.0),
        (["2024-01-01", "2024-01-02", "2024-01-05"], 2 / 3),
        (["2024-01-01", "2024-01-01", "2024-01-02"], 2 / 3),
        (["2024-01-01", None], 1.0),
        ([None, None], 1.0),
    ],
)
def test_date_coverage(spark, values, coverage):
    found = date_coverage(days(spark, *values)).first()
    assert found["coverage"] == pytest.approx(coverage)
    assert found["status"] == ("passed" if coverage >= 0.95 else "warning")


def test_anomalies_and_validation(spark):
    rows = spark.createDataFrame([(-1.0, 10.0), (5.0, 0.0), (None, 9e6)], "price double, bsr double")
    assert tuple(anomaly_counts(rows).first()) == (1, 2)
    assert missing_columns(rows, ("price", "dt")) == ["dt"]
    assert validate_timeseries(rows).failed
    report = validate_timeseries(rows.withColumn("dt", F.lit("2024-01-01").cast("date")), ("price", "dt"))
    found = report.details.first()
    assert not report.failed and found["anomalies"]["invalid_bsr"] == 2


def test_reconciliation(spark):
    before = spark.createDataFrame([("x",)] * 100 + [("y",)] * 100 + [("z",)] * 3, "dataset string")
    after = spark.createDataFrame([("x",)] * 99 + [("y",)] * 98, "dataset string")
    found = {r["dataset"]: (r["raw"], r["processed"]) for r in reconcile_counts(before, after).collect()}
    assert found == {"y": (100, 98), "z": (3, 0)}
