import datetime as dt

from pyspark.sql import functions as F

from checks import bindings
from shelfsight.operators import running


def test_a_task_gets_a_bounded_number_of_rows(spark):
    rows = spark.range(3000).select((F.col("id") % 600).alias("k"))
    dealt = running.spread_keys(rows, ["k"], 3000, task_rows=50)
    assert dealt.rdd.getNumPartitions() == 60
    assert running.spread_keys(rows, ["k"], 3000, task_rows=3000) is rows


def test_the_mart_is_dealt_out_once_for_its_groups_and_what_follows(spark, tmp_path, monkeypatch):
    lines = [(k, k % 7, k % 9, 1 + k % 3, 1.0, 10.0 + k, 0.05, 0.01, "R", "O", dt.datetime(2020, 1, 1 + k % 28)) for k in range(400)]
    columns = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    )
    spark.createDataFrame(lines, columns).write.parquet(str(tmp_path / "lineitem.parquet"))
    plain = bindings.bind(spark, str(tmp_path), "mart").orderBy("asin", "site", "dt").collect()
    monkeypatch.setattr(bindings, "spread_keys", lambda df, by, rows: running.spread_keys(df, by, rows, task_rows=4))
    mart = bindings.bind(spark, str(tmp_path), "mart")
    perkey = mart.groupBy("asin", "site").agg(F.sum("sales").alias("s"))
    assert perkey._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert perkey.rdd.getNumPartitions() == 100
    assert mart.orderBy("asin", "site", "dt").collect() == plain


def test_large_groups_are_dealt_out_whole_and_evenly(spark):
    rows = spark.range(6400).select((F.col("id") % 64).alias("k"), "id")
    dealt = running.range_groups(rows, ["k"], 6400, task_rows=400)
    held = dealt.groupBy("k", F.spark_partition_id().alias("p")).count().collect()
    per_task = {}
    for r in held:
        per_task[r["p"]] = per_task.get(r["p"], 0) + r["count"]
    assert len(held) == 64 and max(per_task.values()) <= 1000
