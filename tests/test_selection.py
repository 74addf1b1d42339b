"""Medians and quota cut-offs by counting, against sorting; plans without windows or range sorts."""

import contextlib
import hashlib
import io
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfsight.operators import running, selection, splits


def values(kind, draw):
    if kind == "even":
        return [draw.uniform(-5, 50) for _ in range(2000)]
    if kind == "ties":
        return [7.0 if draw.random() < 0.6 else draw.uniform(0, 14) for _ in range(1501)]
    if kind == "two":
        return [1.0] * 700 + [2.0] * 700
    if kind == "wide":
        return [draw.choice([-1, 1]) * 10.0 ** draw.uniform(-300, 300) for _ in range(999)] + [float("inf"), 0.0, -0.0]
    return [3.25]


@pytest.mark.parametrize("gathered", [2, 30, selection.GATHERED])
def test_medians_equal_sorting(spark, gathered):
    draw, data, want = random.Random(5), [], {}
    for name in ("even", "ties", "two", "wide", None):
        own = values(name, draw)
        other = [draw.choice([None, 1.0, 2.0, 5.0]) for _ in own]
        data += [(name, a, b) for a, b in zip(own, other)]
        known = [b for b in other if b is not None]
        want[name] = (statistics.median(own), statistics.median(known) if known else None)
    draw.shuffle(data)
    data += [("none", None, None)] * 3
    want["none"] = (None, None)
    df = spark.createDataFrame(data, "g string, v double, u double").repartition(5)
    found = {r["g"]: (r["v"], r["u"]) for r in selection.group_medians(df, ["g"], ["v", "u"], gathered).collect()}
    assert found == want
    whole = selection.group_medians(df.where("g = 'even'"), [], ["v"], gathered).collect()
    assert [r["v"] for r in whole] == [want["even"][0]]
    assert selection.group_medians(df.limit(0), ["g"], ["v"], gathered).count() == 0


def test_medians_gather_only_rows_with_a_value_inside(spark):
    rows = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("v"))
    plan = selection.group_medians(rows, ["g"], ["v"])._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    assert not [x for x in lines if "collect_list(CASE" in x and "count(" in x]
    assert [x for x in lines if "Filter" in x and "_lo_v" in x and "_hi_v" in x]


@pytest.mark.parametrize("gathered", [1, 20, selection.GATHERED])
def test_cutoffs_are_the_digests_at_the_ranks(spark, gathered):
    data = [("a" if k % 3 else None, hashlib.sha256(str(k % 900).encode()).hexdigest()) for k in range(1000)]
    df = spark.createDataFrame(data, "g string, d string").repartition(3)
    ranks = lambda n: F.array(F.lit(1).cast("long"), F.floor(n / 2), n)
    for by in (["g"], []):
        found = selection.digest_cutoffs(df, by, "d", ranks, gathered).collect()
        assert len(found) == (2 if by else 1)
        for r in found:
            own = sorted(d for g, d in data if not by or g == r["g"])
            assert r["cutoffs"] == [own[0], own[len(own) // 2 - 1], own[-1]]


def plan(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_splits_move_no_rows(spark):
    rows = spark.createDataFrame([(k, f"g{k % 12}", k % 3) for k in range(200)], "id int, g string, y int")
    held = [splits.random_holdout(rows, ["id"]), splits.group_holdout(rows, "g"), splits.group_folds(rows, "g", 3)]
    for df in held:
        assert "Exchange" not in plan(df) and "Window" not in plan(df)
    assert "Window" not in plan(splits.stratified_holdout(rows, "y", ["id"]))


def test_splits_of_nothing_and_of_repeated_rows(spark):
    rows = spark.createDataFrame([(k // 2, "a" if k % 5 else None) for k in range(40)], "id int, y string")
    for df in (splits.random_holdout(rows, ["id"], 0.3), splits.stratified_holdout(rows, "y", ["id"], 0.3)):
        sides = df.groupBy("id", "y").agg(F.countDistinct("is_validation").alias("n")).collect()
        assert {r["n"] for r in sides} == {1}
    assert splits.stratified_holdout(rows, "y", ["id"], 0.3).where("y is null and is_validation").count() == 0
    none = rows.limit(0)
    assert splits.random_holdout(none, ["id"]).count() == splits.group_folds(none, "y", 3).count() == 0
    assert splits.stratified_holdout(none, "y", ["id"]).count() == splits.group_holdout(none, "y").count() == 0


@pytest.mark.parametrize("dense", [True, False])
def test_top_ranks_limit_before_they_shuffle(spark, monkeypatch, dense):
    draw = random.Random(2)
    rows = spark.createDataFrame(
        [(draw.choice(["hot", "hot", "x", None]), draw.choice([9.0, 9.0, None, draw.random()])) for _ in range(3000)], "g string, v double"
    ).repartition(4)
    written = []
    monkeypatch.setattr(running, "materialize", lambda df, label: written.append(plan(df)) or df)
    found = running.top_ranks(rows, ["g"], "v", 5, "k", dense)
    rank = (F.dense_rank() if dense else F.rank()).over(Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last()))
    want = rows.withColumn("k", rank).withColumn("k", F.when(F.col("v").isNotNull() & (F.col("k") <= 5), F.col("k").cast("long")))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, found.select("g", "v", "k").collect())) == sorted(map(key, want.collect()))
    text = written[0]
    assert text.rindex("WindowGroupLimit") > text.rindex("Exchange hashpartitioning(g")
