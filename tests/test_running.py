"""Range-sliced paths against plain windows, on hot and ordinary groups."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfsight.operators import running
from shelfsight.operators.running import (
    add_size,
    group_sizes,
    range_slices,
    rank_values,
    running_sums,
    tile_of,
    top_ranks,
)

# Groups above this many rows are cut: 3000 rows make 30 slices.
ALWAYS_SLICED = 100


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(3)
    data = []
    for i in range(3000):
        # One group holds a third of the rows, one value a third of that group.
        group = "hot" if i % 3 == 0 else draw.choice(["a", "b", None, "c"])
        value = None if i % 41 == 0 else (7.0 if i % 9 == 0 else round(draw.uniform(-5, 50), 1))
        data.append((i, group, value, draw.randint(0, 4)))
    return spark.createDataFrame(data, "id int, g string, v double, w int").cache()


def same(left, right):
    key = lambda r: tuple(str(x) for x in r)
    return sorted(left.collect(), key=key) == sorted(right.collect(), key=key)


def test_group_sizes(rows):
    assert group_sizes(rows, ["g"]) == (1000, 3000)
    assert group_sizes(rows, []) == (3000, 3000)
    assert group_sizes(rows.limit(0), ["g"]) == (0, 0)


@pytest.mark.parametrize("by", [["g"], []])
def test_running_sums_match_window(rows, by):
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    window = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    expected = rows.withColumns({"pos": F.sum(F.lit(1)).over(window), "total": F.sum("w").over(window)})
    sums = {"pos": F.lit(1), "total": F.col("w")}
    sliced = running_sums(rows, by, order, sums, ALWAYS_SLICED)
    assert same(sliced.select(expected.columns), expected)
    assert same(running_sums(rows, by, order, sums).select(expected.columns), expected)


def test_a_whole_table_is_always_sliced(rows, monkeypatch):
    cut = []
    monkeypatch.setattr(running, "range_slices", lambda df, by, *rest: cut.append(list(by)) or range_slices(df, by, *rest))
    assert running_sums(rows, [], [F.col("id").asc()], {"pos": F.lit(1)}).where("pos = id + 1").count() == 3000
    assert running_sums(rows, ["g"], [F.col("id").asc()], {"pos": F.lit(1)}).count() == 3000
    assert running_sums(rows.limit(0), [], [F.col("id").asc()], {"pos": F.lit(1)}).count() == 0
    assert cut == [[], []]


def test_sliced_path_really_cuts_a_group(rows):
    ranged = rows.repartitionByRange(30, "g", F.col("v").desc_nulls_last(), "id")
    slices = ranged.where("g = 'hot'").select(F.spark_partition_id().alias("s")).distinct().count()
    assert slices > 1


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("by", [["g"], []])
def test_rank_values_match_on_both_paths(rows, by, descending):
    names = {"rank": "r", "dense": "d", "ties": "t", "size": "n"}
    plain = rank_values(rows, by, "v", descending=descending, **names)
    sliced = rank_values(rows, by, "v", descending=descending, hot_rows=ALWAYS_SLICED, **names)
    assert same(plain, sliced.select(plain.columns))
    missing = plain.where("v IS NULL").select("r", "d", "t").distinct().collect()
    assert [tuple(r) for r in missing] == [(None, None, None)]


@pytest.mark.parametrize("dense", [True, False])
def test_top_ranks_match_window(rows, dense):
    window = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_last())
    function = F.dense_rank() if dense else F.rank()
    ranked = rows.withColumn("k", function.over(window).cast("bigint"))
    expected = ranked.withColumn("k", F.when(F.col("v").isNotNull() & (F.col("k") <= 9), F.col("k")))
    assert same(top_ranks(rows, ["g"], "v", 9, "k", dense).select(expected.columns), expected)


def test_tiles_match_ntile(spark):
    rows = spark.range(1, 48).withColumn("n", F.lit(47).cast("bigint"))
    for tiles in (1, 5, 46, 47, 100):
        own = rows.select("id", tile_of(F.col("id"), F.col("n"), tiles).alias("t"))
        ntile = rows.select("id", F.ntile(tiles).over(Window.orderBy("id")).cast("bigint").alias("t"))
        assert same(own, ntile)


def test_size_counts_null_groups(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, v int")
    assert sorted(r["n"] for r in add_size(rows, ["g"], "n").collect()) == [1, 2, 2]
    assert {r["n"] for r in add_size(rows, [], "n").collect()} == {3}


def test_null_sums_agree_in_both_paths(spark):
    rows = [(k, "g", None if k % 3 else k) for k in range(40)] + [(k, "h", None) for k in range(40)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    sums = {"s": F.col("v")}
    plain = running_sums(df, ["g"], [F.col("id")], sums)
    sliced = running_sums(df, ["g"], [F.col("id")], sums, hot_rows=5)
    assert sorted(map(tuple, plain.collect()), key=str) == sorted(map(tuple, sliced.select(plain.columns).collect()), key=str)


def test_many_hot_groups_do_not_make_a_slice_of_every_few_rows(spark, monkeypatch):
    monkeypatch.setattr(running, "SLICE_ROWS", 100)
    monkeypatch.setattr(running, "FEW_SLICES", 20)
    rows = spark.range(5000).select((F.col("id") % 50).alias("g"), "id")
    sizes = running.group_sizes(rows, ["g"])
    default = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = running.range_slices(rows, ["g"], [F.col("id").asc()], sizes, hot_rows=2)
    assert sliced.select("_slice").distinct().count() <= max(50, default)
    summed = running.running_sums(rows, ["g"], [F.col("id").asc()], {"n": F.lit(1)}, hot_rows=2)
    assert summed.where("n != floor(id / 50) + 1").count() == 0 and summed.count() == 5000
