import math
import random

import pytest

from shelfsight.operators.metrics import (
    binary_metrics,
    lift_curve,
    ranking_metrics,
    regression_metrics,
    roc_auc,
)


def values(df):
    return {r["metric"]: r["value"] for r in df.collect()}


def ranked(spark):
    # Two groups of three; the model puts each group's relevant items first.
    rows = [
        (1, "a", 1, 0.9, 0.2), (2, "a", 0, 0.1, 0.9), (3, "a", 1, 0.8, 0.8),
        (4, "b", 0, 0.2, 0.1), (5, "b", 1, 0.7, 0.9), (6, "b", 0, 0.1, 0.5),
    ]
    return spark.createDataFrame(rows, "id int, g string, y int, s double, b double")


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_ranking_by_hand(spark, hot_rows):
    found = values(ranking_metrics(ranked(spark), "g", "y", "s", "b", (1, 2), ("id",), hot_rows))
    assert found["ndcg@1"] == 1.0 and found["ndcg@2"] == pytest.approx(1.0)
    assert (found["recall@1"], found["recall@2"], found["map"]) == (0.75, 1.0, 1.0)
    # Baseline: group a ranks its hits 2nd and 3rd, group b first.
    assert found["baseline_recall@1"] == 0.5 and found["baseline_recall@2"] == 0.75
    assert found["lift@1"] == 0.25 and found["lift@2"] == 0.25
    assert found["baseline_map"] == pytest.approx(((1 / 2 + 2 / 3) / 2 + 1) / 2)


def brute_ndcg(relevance, k):
    def dcg(items):
        return sum((2.0**r - 1) / math.log2(i + 2) for i, r in enumerate(items[:k]))

    best = dcg(sorted(relevance, reverse=True))
    return dcg(relevance) / best if best else 0.0


@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_graded_ndcg_matches_brute_force(spark, hot_rows):
    draw = random.Random(5)
    rows = [(i, draw.choice("xyz"), draw.randint(0, 3), round(draw.random(), 1)) for i in range(200)]
    rows += [(1000 + i, "none", 0, draw.random()) for i in range(5)]
    df = spark.createDataFrame(rows, "id int, g string, y int, s double")
    found = values(ranking_metrics(df, "g", "y", "s", ks=(3, 10), tie=("id",), hot_rows=hot_rows))
    for k in (3, 10):
        wanted = []
        for g in ("x", "y", "z", "none"):
            group = sorted((r for r in rows if r[1] == g), key=lambda r: (-r[3], r[0]))
            wanted.append(brute_ndcg([r[2] for r in group], k))
        assert found[f"ndcg@{k}"] == pytest.approx(sum(wanted) / 4)


def test_nothing_to_rank(spark):
    found = values(ranking_metrics(ranked(spark).limit(0), "g", "y", "s", ks=(5,), tie=("id",)))
    assert found == {"ndcg@5": None, "recall@5": None, "map": None}


def test_lift_curve(spark):
    found = {r["k"]: r for r in lift_curve(ranked(spark), "g", "y", "s", "b", (1, 2), ("id",)).collect()}
    assert (found[1]["recall"], found[1]["baseline_recall"], found[1]["lift"]) == (0.75, 0.5, 0.25)
    with pytest.raises(ValueError):
        lift_curve(ranked(spark), "g", "y", "s", "missing")


def test_binary_metrics(spark):
    rows = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.6), (0, 0.1), (1, 0.5)], "y int, p double")
    found = values(binary_metrics(rows, "y", "p"))
    assert found["accuracy"] == 0.6
    assert found["precision"] == pytest.approx(2 / 3) and found["recall"] == pytest.approx(2 / 3)
    assert found["f1"] == pytest.approx(2 / 3)
    assert found["balanced_accuracy"] == pytest.approx((2 / 3 + 1 / 2) / 2)
    assert found["roc_auc"] == pytest.approx(4 / 6)
    logs = [math.log(0.9), math.log(0.4), math.log(0.4), math.log(0.9), math.log(0.5)]
    assert found["log_loss"] == pytest.approx(-sum(logs) / 5)


def test_undefined_binary_metrics(spark):
    rows = spark.createDataFrame([(0, 0.1), (0, 1.0)], "y int, p double")
    found = values(binary_metrics(rows, "y", "p"))
    assert found["recall"] is None and found["roc_auc"] is None and found["f1"] is None
    assert found["precision"] == 0.0 and found["log_loss"] > 10


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_auc_with_ties_counts_pairs(spark, hot_rows):
    draw = random.Random(9)
    rows = [(draw.randint(0, 1), round(draw.random(), 1)) for _ in range(120)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "y int, s double")
    assert roc_auc(df, "y", "s", hot_rows).first()["roc_auc"] == pytest.approx(wins)


def test_regression_metrics(spark):
    rows = spark.createDataFrame([(1.0, 1.5), (2.0, 1.0), (3.0, 3.0)], "y double, p double")
    found = values(regression_metrics(rows, "y", "p"))
    assert found["mse"] == pytest.approx(1.25 / 3) and found["mae"] == pytest.approx(0.5)
    assert found["rmse"] == pytest.approx(math.sqrt(1.25 / 3)) and found["r2"] == pytest.approx(1 - 1.25 / 2)
    flat = spark.createDataFrame([(1.0, 1.5), (1.0, 1.0)], "y double, p double")
    assert values(regression_metrics(flat, "y", "p"))["r2"] is None


def test_a_null_group_counts_like_any_other(spark):
    rows = [(g, label, float(label), float(label)) for g in ("a", None) for label in (0, 1, 2)]
    df = spark.createDataFrame(rows, "g string, y int, s double, b double")
    for baseline in (None, "b"):
        got = {r.metric: r.value for r in ranking_metrics(df, "g", "y", "s", baseline, ks=(1,)).collect()}
        assert got["ndcg@1"] == 1.0
