import math
import random

import pytest
from pyspark.sql import functions as F

from shelfsight.operators.search import Range, adaptive_search
from shelfsight.operators import splits, text, training


def words(spark, *items):
    return spark.createDataFrame(list(enumerate(items)), "pos int, word string")


def test_keyword_cleaning(spark):
    rows = words(spark, " Wireless ", "and", "Prime", "", "WIRELESS", "the", None, " mouse\t", "prime", "Amazon")
    found = text.clean_keywords(rows, "word", ("pos",)).orderBy("first_pos").collect()
    assert [r["keyword"] for r in found] == ["Wireless", "Prime", "mouse", "Amazon"]
    assert [r["first_pos"] for r in found] == [0, 2, 7, 9]


def test_keyword_scopes(spark):
    rows = spark.createDataFrame([("x", 1, "Cup"), ("x", 0, "cup"), ("y", 5, "CUP")], "site string, pos int, word string")
    found = text.clean_keywords(rows, "word", ("pos",), ("site",)).collect()
    assert {(r["site"], r["keyword"]) for r in found} == {("x", "cup"), ("y", "CUP")}


def test_request_keywords(spark):
    rows = spark.createDataFrame([([" a ", "", None, "\t", "b"],)], "k array<string>")
    assert rows.select(text.clean_keyword_array(F.col("k")).alias("k")).first()["k"] == ["a", "b"]


@pytest.mark.parametrize("hot_rows", [2, 1000])
def test_comment_batches(spark, hot_rows):
    rows = spark.createDataFrame([("p", i, f"c{i}") for i in range(23)] + [("q", 0, "only")], "asin string, i int, body string")
    found = text.comment_batches(rows, "body", ("i",), 10, ("asin",), hot_rows).collect()
    sizes = {(r["asin"], r["batch_index"]): r["comments"] for r in found}
    assert {k: len(v) for k, v in sizes.items()} == {("p", 0): 10, ("p", 1): 10, ("p", 2): 3, ("q", 0): 1}
    assert sizes[("p", 1)] == [f"c{i}" for i in range(10, 20)]
    prompt = next(r["prompt"] for r in found if r["asin"] == "q")
    assert "comments:\n- only\n\nFormat the answer" in prompt
    with pytest.raises(ValueError):
        text.comment_batches(rows, "body", ("i",), 0)


def test_summaries_use_the_given_generator(spark):
    rows = spark.createDataFrame([(i, f"c{i}\nmore") for i in range(3)], "i int, body string")
    batches = text.comment_batches(rows, "body", ("i",), 2)
    offline = text.summary_documents(text.summarise_batches(batches)).orderBy("batch_index").collect()
    assert [r["summary"] for r in offline] == ["- c0\n- c1", "- c2"] and offline[0]["model"] == "offline"

    def shout(frames):
        for f in frames:
            yield f.assign(summary=f["prompt"].str.len().astype(str) + " ", model="m1")

    found = text.summary_documents(text.summarise_batches(batches, shout)).collect()
    assert all(r["summary"] == str(len(r["prompt"])) and r["model"] == "m1" for r in found)


def test_embedding_and_clusters(spark):
    vectors = {"cup": [0.0, 0.1], "mug": [0.1, 0.0], "car": [5.0, 5.1]}

    def embed(frames):
        for f in frames:
            yield f.assign(embedding=f["keyword"].map(vectors))

    rows = spark.createDataFrame([(k,) for k in vectors], "keyword string")
    clusters = text.cluster_vectors(text.embed_keywords(rows, embed), num_clusters=2)
    member = {r["keyword"]: r["cluster_id"] for r in clusters.members.collect()}
    assert member["cup"] == member["mug"] != member["car"]
    centre = {r["cluster_id"]: (r["keyword_count"], r["centroid"]) for r in clusters.centroids.collect()}
    assert centre[member["car"]] == (1, [5.0, 5.1])
    assert centre[member["cup"]][1] == pytest.approx([0.05, 0.05])


def test_cluster_limits(spark):
    one = spark.createDataFrame([([1.0, 2.0],)], "embedding array<double>")
    found = text.cluster_vectors(one, num_clusters=5)
    assert found.k == 1 and found.members.first()["cluster_id"] == 0
    with pytest.raises(ValueError):
        text.cluster_vectors(one.limit(0))
    with pytest.raises(ValueError):
        text.cluster_vectors(one.unionByName(spark.createDataFrame([([1.0],)], one.schema)))


def items(spark, n=200):
    draw = random.Random(2)
    data = [(i, f"g{draw.randint(0, 10)}", int(draw.random() < 0.2)) for i in range(n)]
    return spark.createDataFrame(data, "id int, g string, y int")


def test_group_holdout(spark):
    out = splits.group_holdout(items(spark), "g", 0.25)
    sides = {r["g"]: r["s"] for r in out.groupBy("g").agg(F.collect_set("is_validation").alias("s")).collect()}
    assert all(len(s) == 1 for s in sides.values())
    assert sum(s[0] for s in sides.values()) == 3 and out.count() == 200


def test_stratified_and_random_sizes(spark):
    rows = items(spark)
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    out = splits.stratified_holdout(rows, "y", ["id"], 0.15).where("is_validation")
    held = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert held == {y: -(-n * 15 // 100) for y, n in sizes.items()}
    assert splits.random_holdout(rows, ["id"], 0.001).where("is_validation").count() == 1
    assert splits.random_holdout(rows, ["id"], 0.1).where("is_validation").count() == 20


def test_folds(spark):
    out = splits.group_folds(items(spark), "g", 4)
    groups = {r["fold"]: r["n"] for r in out.groupBy("fold").agg(F.countDistinct("g").alias("n")).collect()}
    assert sorted(groups.items()) == [(0, 3), (1, 3), (2, 3), (3, 2)]
    with pytest.raises(ValueError):
        splits.group_folds(items(spark), "g", 1)
    with pytest.raises(Exception, match="not enough groups"):
        splits.group_folds(items(spark), "g", 12).collect()


def learnable(spark, n=300):
    draw = random.Random(4)
    data = []
    for i in range(n):
        x, noise = draw.random(), draw.random()
        data.append((i, f"g{i % 12}", x, noise, None if i % 50 == 0 else x * 2, int(x > 0.6), x * 3 + noise / 10))
    return spark.createDataFrame(data, "id int, group_id string, x double, noise double, z double, y int, label double")


def metric(fitted, name, part="validation"):
    rows = fitted.metrics.where((F.col("metric") == name) & (F.col("part") == part)).collect()
    return rows[0]["value"]


@pytest.mark.parametrize("kind", ["gbt", "forest", "linear"])
def test_classifier_learns(spark, kind):
    options = {"gbt": {"maxIter": 5}, "forest": {"numTrees": 5}, "linear": {"maxIter": 30}}[kind]
    fitted = training.train_classifier(learnable(spark), "y", ["id", "group_id"], kind, drop=["label"], **options)
    assert metric(fitted, "roc_auc") > 0.9
    top = fitted.importances.collect()
    # z doubles x, so either may carry the signal.
    assert top[0]["feature"] in ("x", "z") and (top[0]["split"] is None) == (kind == "linear")
    assert fitted.predictions.count() == 61


def test_regressor_and_errors(spark):
    fitted = training.train_regressor(learnable(spark), "label", ["id", "group_id"], "forest", drop=["y"], numTrees=5)
    assert metric(fitted, "r2") > 0.8
    with pytest.raises(ValueError, match="unsupported"):
        training.train_regressor(learnable(spark), "label", ["id", "group_id"], "boosted-magic")
    with pytest.raises(KeyError):
        training.train_classifier(learnable(spark), "absent", ["id"])
    with pytest.raises(ValueError, match="numeric"):
        training.feature_columns(learnable(spark).select("group_id"), [])


def test_ranker_and_tuning(spark):
    rows = learnable(spark).withColumn("label", F.round("label"))
    fitted = training.train_ranker(rows, ["id"], baseline="noise", drop=["y"], kind="gbt", maxIter=5)
    found = {r["metric"]: r["value"] for r in fitted.metrics.collect()}
    assert found["ndcg@20"] > 0.8 and "lift@5" in found and fitted.lift.count() == 4
    best, trials, model = training.tune_ranker(rows, ["id"], folds=2, trials=2, drop=["y"], maxIter=2, parallelism=2)
    assert model.transform(rows.withColumns({c: F.col(c).cast("double") for c in ("x", "noise", "z")})).count() == 300
    scores = [r["ndcg"] for r in trials.orderBy("trial").collect()]
    assert len(scores) == 2 and best["maxDepth"] in (3, 4, 5, 6, 7)


def test_class_balance(spark):
    rows = spark.createDataFrame([(1,), (0,), (0,)], "y int")
    assert training.class_balance(rows, "y") == 2.0
    assert training.class_balance(rows.where("y = 0"), "y") is None


def test_column_means_come_from_training_rows_only(spark):
    rows = spark.createDataFrame(
        [(i, float(i), 1.0 if i < 8 else 1e6, i >= 8) for i in range(10)], "id int, y double, x double, is_validation boolean"
    )
    learner = training.GBTRegressor(
        featuresCol=training.FEATURES, labelCol="y", maxIter=2, validationIndicatorCol=training.HELD
    )
    fitted = training._fit_pipeline(rows, ["x"], learner, True)
    assert fitted.stages[0].surrogateDF.first()["x"] == 1.0


def test_a_fold_does_not_see_its_outliers(spark):
    rows = spark.createDataFrame(
        [(k, k % 3, 1e6 if k == 0 else None if k < 6 else float(k % 3)) for k in range(60)], "id int, fold int, x double"
    )
    means = []
    for part in training.prepared_folds(rows, ["x"], 3):
        filled = part.where("x is null").select(training.vector_to_array(training.FEATURES)[0].alias("v")).distinct().collect()
        means.append(filled[0]["v"])
    assert means[0] < 3 and means[1] > 1e4 and means[2] > 1e4


def test_adaptive_search_beats_random_draws():
    space = {"a": Range(0.001, 10.0, log=True), "b": Range(-5.0, 5.0), "n": Range(1, 9, whole=True)}

    def score(s):
        return -((math.log10(s["a"]) + 1) ** 2) - (s["b"] - 2) ** 2 / 4 - (s["n"] - 7) ** 2 / 8

    adaptive, plain = [], []
    for seed in range(12):
        adaptive.append(max(v for _, v in adaptive_search(space, score, 50, seed, parallelism=4)))
        rng = random.Random(seed)
        plain.append(max(score({n: r.value(rng.random()) for n, r in space.items()}) for _ in range(50)))
    assert sum(adaptive) / 12 > sum(plain) / 12 + 0.05
    tried = adaptive_search(space, score, 7, 1)
    assert len(tried) == 7 and all(0.001 <= s["a"] <= 10 and -5 <= s["b"] <= 5 and s["n"] in range(1, 10) for s, _ in tried)
    assert adaptive_search(space, score, 7, 1) == tried
