import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfsight.operators import alerts, calendar, reporting, views
from shelfsight.schemas import AI_CLUSTERS, AI_SUMMARIES, CATEGORY_SNAPSHOT, PREDICTIONS_DAILY
from shelfsight.settings import AlertLimits, ReportSettings

TODAY = dt.date(2024, 5, 20)


def ago(n):
    return TODAY - dt.timedelta(days=n)


@pytest.fixture(scope="module")
def tables(spark):
    predictions, snapshot, texts, labels = [], [], [], []
    for n in range(7):
        for i in range(1, 6):
            category = "Electronics" if i % 2 == 0 else "Toys"
            predictions.append((ago(n), f"ASIN{i}", "US", category, 1000.0 + 50 * i + 10 * n, 20.0 + 2 * i, 0.8 + 0.01 * i))
        texts.append((ago(n), "ASIN1", "US", "Great attachment quality"))
        labels.append((ago(n), "ASIN1", "US", "travel accessories"))
    for n in range(14):
        snapshot += [(ago(n), "Electronics", 1200.0 + 5 * n, 25.0), (ago(n), "Toys", 900.0 + 3 * n, 18.0)]
    return (
        spark.createDataFrame(predictions, PREDICTIONS_DAILY),
        spark.createDataFrame(snapshot, CATEGORY_SNAPSHOT),
        spark.createDataFrame(texts, AI_SUMMARIES),
        spark.createDataFrame(labels, AI_CLUSTERS),
    )


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_top_candidates(tables, hot_rows):
    view = views.top_candidates_daily(*tables, top=3, hot_rows=hot_rows)
    today = view.where(F.col("snapshot_date") == F.lit(TODAY)).orderBy("revenue_rank").collect()
    assert [r["asin"] for r in today] == ["ASIN5", "ASIN4", "ASIN3"]
    assert [r["quality_rank"] for r in today] == [1, 2, 3]
    assert today[0]["revenue_vs_category"] == pytest.approx(1250 - 900)
    assert today[0]["ai_comment_summary"] is None
    assert views.top_candidates_daily(*tables).count() == 35


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_pred_ranks(tables, hot_rows):
    rows = views.pred_rank_daily(tables[0], hot_rows=hot_rows).where(F.col("snapshot_date") == F.lit(TODAY))
    found = {r["asin"]: r for r in rows.collect()}
    assert [found[f"ASIN{i}"]["revenue_percentile"] for i in range(1, 6)] == [0.0, 0.25, 0.5, 0.75, 1.0]
    assert [found[f"ASIN{i}"]["units_ntile"] for i in range(1, 6)] == [5, 4, 3, 2, 1]


def test_pred_rank_of_a_single_row(tables):
    found = views.pred_rank_daily(tables[0].where("asin = 'ASIN1'")).first()
    assert found["revenue_percentile"] == 0.0 and found["revenue_ntile"] == 1


def test_latest_rows(spark):
    rows = [("A", "US", "f", 0.1, dt.datetime(2024, 1, 1)), ("A", "US", "f", 0.2, dt.datetime(2024, 1, 2)), ("A", "US", "g", None, dt.datetime(2024, 1, 1))]
    history = spark.createDataFrame(rows, "asin string, site string, feature_name string, feature_value double, snapshot_ts timestamp")
    found = {r["feature_name"]: r["feature_value"] for r in views.features_latest_long(history).collect()}
    assert found == {"f": 0.2, "g": None}


def test_weekly_report(tables):
    view = views.top_candidates_daily(*tables)
    report = reporting.weekly_report(view, tables[0], TODAY, ReportSettings(ai_enabled=True, max_top_candidates=7))
    top = report.top_candidates.collect()
    assert len(top) == 7 and top[0]["snapshot_date"] == TODAY and top[0]["quality_rank"] == 1
    deltas = {r["category"]: r for r in report.category_deltas.collect()}
    # Each day back adds 10 per row: two Electronics rows, three Toys rows.
    assert deltas["Electronics"]["delta"] == pytest.approx(-20.0) and deltas["Toys"]["delta"] == pytest.approx(-30.0)
    assert deltas["Toys"]["delta_pct"] == pytest.approx(-30 / 3480)
    assert deltas["Toys"][TODAY.isoformat()] == pytest.approx(3450.0)
    texts = {r["AI 摘要"] for r in report.ai_comment_summaries.collect()}
    assert texts == {"待运营审核", "Great attachment quality"}


def test_report_without_ai_columns(tables):
    view = views.top_candidates_daily(*tables).drop("ai_comment_summary")
    report = reporting.weekly_report(view, tables[0], TODAY, ReportSettings(ai_enabled=True))
    assert report.ai_comment_summaries is None and report.ai_keyword_clusters is None
    with pytest.raises(KeyError):
        reporting.ai_section(view, "ai_comment_summary", "x", "-")


def test_empty_ai_section_has_a_placeholder(tables):
    view = views.top_candidates_daily(*tables).limit(0)
    assert [r["x"] for r in reporting.ai_section(view, "ai_comment_summary", "x", "-").collect()] == ["-"]


def test_deltas_of_one_day_or_zero(spark):
    rows = [(TODAY, "a", 5.0), (TODAY, "b", 1.0)]
    view = spark.createDataFrame(rows, "snapshot_date date, category string, predicted_revenue double")
    assert {(r["delta"], r["delta_pct"]) for r in reporting.category_deltas(view, TODAY).collect()} == {(0.0, None)}
    more = view.unionByName(spark.createDataFrame([(ago(1), "a", 0.0)], view.schema))
    found = {r["category"]: (r["delta"], r["delta_pct"]) for r in reporting.category_deltas(more, TODAY).collect()}
    assert found == {"a": (5.0, None), "b": (None, None)}


def test_anomalies(spark):
    revenue = [1000, 1020, 1030, 1600, 1040, 1050, 1060]
    rows = [(ago(6 - i), "US", "Toys", float(v)) for i, v in enumerate(revenue)]
    rows += [(ago(i), "US", "flat", 5.0) for i in range(7)]
    df = spark.createDataFrame(rows, "snapshot_date date, site string, category string, predicted_revenue double")
    assert reporting.revenue_anomalies(df, TODAY).count() == 0
    found = reporting.revenue_anomalies(df, TODAY, 2.0).collect()
    assert [(r["predicted_revenue"], r["z_score"]) for r in found] == [(1600.0, 2.439)]


def monitored(spark):
    quality = spark.createDataFrame([(1.0, None), (2.0, None), (None, 1.0)], "a double, b double")
    predictions = spark.createDataFrame([("A", "US", TODAY, 50.0), ("B", "US", TODAY, 10.0)], "asin string, site string, snapshot_date date, predicted_revenue double")
    actuals = spark.createDataFrame([("A", "US", TODAY, 100.0, 99.0), ("B", "US", TODAY, 0.0, 1.0)], "asin string, site string, snapshot_date date, actual_revenue double, predicted_revenue double")
    now = spark.createDataFrame([(1.3, 5.0), (1.3, 5.0)], "feature_a double, feature_b double")
    then = spark.createDataFrame([(1.0, 5.0), (1.0, 5.0)], "feature_a double, feature_b double")
    start = dt.datetime(2024, 5, 20)
    runs = spark.createDataFrame([("daily", start, start + dt.timedelta(minutes=200)), ("ok", start, start + dt.timedelta(minutes=90))], "pipeline string, scheduled_at timestamp, completed_at timestamp")
    return quality, predictions, actuals, now, then, runs


def test_alert_run(spark):
    found = {r["category"]: r for r in alerts.run_alerts(*monitored(spark)).collect()}
    assert set(found) == {"data_quality", "performance", "drift", "sla"}
    assert found["data_quality"]["message"] == "predictions_daily missing ratio 50.00% exceeds threshold"
    assert found["performance"]["message"] == "Model accuracy dropped to 50.00%"
    assert found["drift"]["message"] == "Feature feature_a drift score 0.30 exceeds threshold"
    assert found["sla"]["details"] == {"pipeline": "daily", "delay_minutes": "200.0"}
    lines = [r["line"] for r in alerts.alert_lines(alerts.sla_alerts(monitored(spark)[5])).collect()]
    assert lines == ["[HIGH] sla: SLA breach detected"]


def test_quiet_checks(spark):
    quality, predictions, actuals, now, then, runs = monitored(spark)
    assert alerts.accuracy_alerts(predictions.limit(0), actuals).count() == 0
    assert alerts.sla_alerts(runs.drop("pipeline")).count() == 0
    assert alerts.drift_alerts(now, now).count() == 0
    assert alerts.quality_alerts(quality.select(F.coalesce("a", F.lit(0.0)).alias("a")), "x").count() == 0
    zero = actuals.where("actual_revenue = 0")
    assert alerts.accuracy(predictions, zero).first()["accuracy"] == 1.0
    assert alerts.run_alerts(quality, predictions, actuals, now, then, runs, AlertLimits(0.0, 0.0, 9.0, 999.0)).count() == 0


def test_calendar_windows(spark):
    days = spark.createDataFrame([(ago(i),) for i in range(5)], "d date")
    found = calendar.rolling_window_dates(days.limit(1), "d", 7, lookback=3).orderBy("day").collect()
    assert [r["day"] for r in found] == [ago(2), ago(1), TODAY]
    pairs = {(r["start"], r["end"]) for r in calendar.window_pairs(days, "d", 3).collect()}
    assert pairs == {(ago(4), ago(2)), (ago(3), ago(1)), (ago(2), TODAY)}
