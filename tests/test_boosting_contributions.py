"""Lambda gradients against all pairs, listwise against pointwise, and contributions against the score."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfsight.operators import boosting, contributions, lockstep, search, training
from shelfsight.operators.inference import CONTRIBUTIONS, PipelineScorer, score_batch
from shelfsight.settings import ScoringSettings
from shelfsight.sources import scratch
from tests.test_text_splits_training import learnable


def brute_force(rows, top):
    """Gradient and curvature of every row from all pairs of its group."""
    groups = defaultdict(list)
    for r in rows:
        groups[r[0]].append(r)
    grad, hess = defaultdict(float), defaultdict(float)
    for own in groups.values():
        place = {r[1]: k + 1 for k, r in enumerate(sorted(own, key=lambda r: (-r[3], r[1])))}
        disc = {row: 1 / math.log2(p + 1) if p <= top else 0.0 for row, p in place.items()}
        best = sum(g / math.log2(k + 2) for k, g in enumerate(sorted((r[2] for r in own), reverse=True)[:top]))
        for a in own:
            for b in own:
                if a[2] > b[2] and best:
                    slope = 1 / (1 + math.exp(a[3] - b[3]))
                    change = (a[2] - b[2]) * abs(disc[a[1]] - disc[b[1]]) / best
                    grad[a[1]] += slope * change
                    grad[b[1]] -= slope * change
                    hess[a[1]] += slope * (1 - slope) * change
                    hess[b[1]] += slope * (1 - slope) * change
    return grad, hess


@pytest.mark.parametrize("top", [1, 3, 30])
def test_lambda_gradients_equal_all_pairs(spark, top):
    draw = random.Random(3)
    rows = [(f"g{k % 4}", k, float(draw.choice([0, 0, 1, 3])), draw.choice([0.0, draw.random()])) for k in range(60)]
    rows += [("alone", 100, 3.0, 0.1), ("flat", 101, 0.0, 0.2), ("flat", 102, 0.0, 0.4)]
    df = spark.createDataFrame(rows, "_group string, _row long, _gain double, _score double")
    found = {r["_row"]: r for r in boosting.lambda_gradients(df, boosting.ideal(df, top), top).collect()}
    grad, hess = brute_force(rows, top)
    assert set(found) == {r[1] for r in rows if r[0] != "flat"}
    for row, r in found.items():
        assert math.isclose(r["_grad"], grad[row], abs_tol=1e-12) and math.isclose(r["_hess"], hess[row], abs_tol=1e-12)


def lists(spark, groups=24, size=60):
    """Most of the relevance belongs to a whole list, so a regression spends its trees on `a` and `b`; only `x` orders a list."""
    draw, data = random.Random(11), []
    for g in range(groups):
        shift = draw.randint(0, 6)
        for k in range(size):
            x = draw.random()
            own = 2.0 if x + draw.gauss(0, 0.1) > 0.9 else 1.0 if x + draw.gauss(0, 0.1) > 0.6 else 0.0
            a, b = shift + draw.gauss(0, 0.7), (shift * 5) % 7 + draw.gauss(0, 0.7)
            data.append((g * size + k, f"q{g}" if g else None, a, b, x, own + shift))
    return spark.createDataFrame(data, "id int, query string, a double, b double, x double, relevance double")


def test_listwise_ranks_above_pointwise(spark):
    rows, found = lists(spark), {}
    for kind in ("listwise", "gbt"):
        fitted = training.train_ranker(
            rows, ["id"], group="query", label="relevance", kind=kind, maxIter=12, stepSize=0.1, maxDepth=3
        )
        found[kind] = {r["metric"]: r["value"] for r in fitted.metrics.collect()}["ndcg@20"]
        assert fitted.importances.count() == 3
    assert found["listwise"] > found["gbt"] + 0.02


def test_listwise_stops_early_and_saves(spark, tmp_path):
    rows = lists(spark, 8, 20).withColumn("is_validation", F.coalesce(F.col("query").isin("q1", "q2"), F.lit(False)))
    rows = training.VectorAssembler(inputCols=["a", "x"], outputCol="v").transform(rows)
    model = boosting.fit_listwise(rows, "query", "relevance", "is_validation", "v", boosting.Boosting(maxIter=12, patience=1, minInstancesPerNode=2))
    assert 1 <= len(model.treeWeights) < 12 and model.numFeatures == 2
    model.save(str(tmp_path / "m"))
    loaded = type(model).load(str(tmp_path / "m"))
    mine, other = (m.transform(rows).agg(F.sum("prediction")).first()[0] for m in (model, loaded))
    assert math.isclose(mine, other)
    with pytest.raises(ValueError, match="relevance"):
        boosting.fit_listwise(rows.withColumn("relevance", F.lit(1.0)), "query", "relevance", "is_validation", "v")


def test_rounds_run_on_as_few_tasks_as_the_rows_need(spark, monkeypatch):
    rows = lists(spark, 8, 20).withColumn("is_validation", F.coalesce(F.col("query").isin("q1", "q2"), F.lit(False)))
    rows = training.VectorAssembler(inputCols=["a", "x"], outputCol="v").transform(rows)
    seen, judge = [], boosting.ndcg

    def watched(held, *rest):
        seen.append((held.sparkSession.conf.get("spark.sql.shuffle.partitions"), held.rdd.getNumPartitions()))
        return judge(held, *rest)

    monkeypatch.setattr(boosting, "ndcg", watched)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    settings = boosting.Boosting(maxIter=boosting.WRITE_EVERY + 2, minInstancesPerNode=2)
    boosting.fit_listwise(rows, "query", "relevance", "is_validation", "v", settings)
    assert seen == [("1", 1)] * len(seen) and len(seen) == boosting.WRITE_EVERY + 2
    assert spark.conf.get("spark.sql.shuffle.partitions") == before != "1"


def test_scores_of_a_round_are_those_of_all_trees(spark, monkeypatch):
    rows = lists(spark, 8, 20).withColumn("is_validation", F.coalesce(F.col("query").isin("q1", "q2"), F.lit(False)))
    rows = training.VectorAssembler(inputCols=["a", "x"], outputCol="v").transform(rows)
    seen = []

    def rising(held, *rest):  # every round is the best so far, so all trees are kept
        seen.append(sorted(r["_score"] for r in held.select("_score").collect()))
        return float(len(seen))

    monkeypatch.setattr(boosting, "ndcg", rising)
    monkeypatch.setattr(boosting, "WRITE_EVERY", 2)
    model = boosting.fit_listwise(rows, "query", "relevance", "is_validation", "v", boosting.Boosting(maxIter=5, minInstancesPerNode=2))
    want = sorted(r["prediction"] for r in model.transform(rows.where("is_validation")).collect())
    assert len(model.treeWeights) == len(seen) == 5 and seen[-1] == pytest.approx(want, abs=1e-12)


def test_dealt_out_rows_are_all_there_and_limit_tasks(spark, monkeypatch):
    monkeypatch.setattr(scratch, "LOOP_ROWS", 10)
    monkeypatch.setattr(scratch, "TASK_ROWS", 1000)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for n, tasks in ((0, 1), (20, min(2, most)), (10 * most + 500, most)):
        out = scratch.materialize_for_loop(spark.range(n), "loop")
        assert out.sparkSession.conf.get("spark.sql.shuffle.partitions") == str(tasks)
        assert out.sparkSession.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
        assert sorted(r["id"] for r in out.collect()) == list(range(n))


def test_folds_are_read_by_as_few_tasks_as_the_rows_need(spark):
    rows = learnable(spark).withColumn("fold", F.col("id").cast("long") % 3)
    for part in training.prepared_folds(training._as_double(rows, ["x", "label"]), ["x"], 3):
        assert part.sparkSession.conf.get("spark.sql.shuffle.partitions") == "1" and part.count() == rows.count()


@pytest.mark.parametrize("kind", ["gbt", "forest", "linear"])
@pytest.mark.parametrize("task", ["regression", "classes"])
def test_contributions_and_base_sum_to_the_score(spark, kind, task):
    rows = learnable(spark)
    options = {"gbt": {"maxIter": 6}, "forest": {"numTrees": 4}, "linear": {"regParam": 0.1}}[kind]
    fit, target, drop = (
        (training.train_regressor, "label", ["y"]) if task == "regression" else (training.train_classifier, "y", ["label"])
    )
    fitted = fit(rows, target, ["id", "group_id"], kind, drop=drop, **options)
    found = contributions.explained(rows, fitted.model, fitted.features, "s", "parts", "base").collect()
    scored = fitted.model.transform(rows.withColumns({c: F.col(c).cast("double") for c in fitted.features}))
    if task == "regression":
        want = {r["id"]: r["prediction"] for r in scored.collect()}
    elif kind == "forest":
        want = {r["id"]: r["probability"][1] for r in scored.collect()}
    else:
        want = {r["id"]: math.log(r["probability"][1] / r["probability"][0]) for r in scored.collect()}
    assert len(found) == len(want) == 300
    for r in found:
        assert math.isclose(r["s"], want[r["id"]], abs_tol=1e-9)
        assert math.isclose(r["base"] + sum(r["parts"].values()), r["s"], abs_tol=1e-9)
        assert set(r["parts"]) == set(fitted.features)
        if kind == "linear" and r["z"] is None:
            assert r["parts"]["z"] == 0


def test_path_contributions_follow_the_path():
    import numpy as np

    # One tree: x0 <= 1 ? 10 : (x1 <= 5 ? 20 : 40), with node means 22 and 30.
    nodes = contributions.NodeTable(
        np.array([0, -1, 1, -1, -1]), np.array([1.0, 0, 5.0, 0, 0]), np.array([1, -1, 3, -1, -1]), np.array([2, -1, 4, -1, -1]),
        np.array([22.0, 10, 30, 20, 40]), np.array([0]),
    )
    got = contributions.path_contributions(nodes, np.array([[0.0, 9.0], [2.0, 5.0], [2.0, 6.0]]))
    assert got.tolist() == [[-12, 0], [8, -10], [8, 10]] and nodes.base == 22


def test_a_fitted_pipeline_gives_reasons(spark):
    fitted = training.train_regressor(learnable(spark), "label", ["id", "group_id"], "gbt", drop=["y"], maxIter=4)
    rows = learnable(spark).select(
        F.concat(F.lit("A"), "id").alias("asin"), F.lit("US").alias("site"), F.lit("2024-01-02").alias("dt"),
        F.lit("c").alias("category"), F.lit("low").alias("price_band"), *fitted.features,
    )
    out = score_batch(rows, PipelineScorer(fitted.model, fitted.features), ScoringSettings(top_contributors=2))
    assert CONTRIBUTIONS not in out.columns
    first = out.orderBy("rank_in_group").first()
    reason = out.select(F.from_json("reason", "map<string,double>").alias("m")).first()["m"]
    assert len(reason) == 2 and first["rank_in_group"] == 1


def on_folds(spark, n=700):
    """Rows in two slices, with repeated values, an alike and a constant column, and repeated rows."""
    draw = random.Random(5)
    data = [(float(draw.randint(0, 9)), round(draw.random(), 2), draw.gauss(0, 1)) for _ in range(n)]
    data += data[:50]
    rows = [(k, f"q{k % 6}", k % 3, a, b, c, a * 2, 1.0, float(round(a / 4 + b + c / 5))) for k, (a, b, c) in enumerate(data)]
    df = spark.createDataFrame(rows, "id int, query string, fold int, a double, b double, c double, d double, e double, relevance double")
    return training.VectorAssembler(inputCols=["a", "b", "c", "d", "e"], outputCol=training.FEATURES).transform(df).repartition(2).cache()


SETTINGS = (
    {"stepSize": 0.1, "maxDepth": 4, "minInstancesPerNode": 5, "subsamplingRate": 0.7},
    {"stepSize": 0.05, "maxDepth": 1, "minInstancesPerNode": 20, "subsamplingRate": 1.0, "minInfoGain": 0.01},
    {"stepSize": 0.2, "maxDepth": 0, "minInstancesPerNode": 1, "subsamplingRate": 0.5},
)


@pytest.mark.parametrize("task_rows, sum_bytes", [(10**6, lockstep.SUM_BYTES), (10, lockstep.SUM_BYTES), (10, 1)])
def test_fits_grown_side_by_side_equal_single_fits(spark, monkeypatch, task_rows, sum_bytes):
    monkeypatch.setattr(lockstep, "SUM_BYTES", sum_bytes)
    rows = on_folds(spark)

    def learner(s):
        return training.GBTRegressor(featuresCol=training.FEATURES, labelCol="relevance", maxIter=3, maxBins=8, seed=7, **s)

    parts = [rows.where(F.col("fold") != f) for f in range(2)]
    folds = [lockstep.prepare(part, learner({})) for part in parts]
    values = [lockstep.setting(learner(s)) for s in SETTINGS]
    fits = lockstep.fit(folds, values, task_rows)
    for f, part in enumerate(parts):
        scored = lockstep.score(rows, training.FEATURES, folds[f].borders, values, [of[f] for of in fits])
        assert training.FEATURES not in scored.columns and scored.count() == 3 * rows.count()
        for k, s in enumerate(SETTINGS):
            own = {r["id"]: r["prediction"] for r in scored.where(F.col("_fit") == k).collect()}
            want = {r["id"]: r["prediction"] for r in learner(s).fit(part).transform(rows).collect()}
            assert own == pytest.approx(want, abs=1e-9)


def test_draws_are_those_of_sparks_generator(spark):
    jvm = spark.sparkContext._jvm
    theirs = jvm.org.apache.spark.util.random.XORShiftRandom(11)
    start = getattr(getattr(jvm, "org.apache.spark.util.random.XORShiftRandom$"), "MODULE$").hashSeed(11) % (1 << 64)
    assert lockstep.draws(start, 301).tolist() == [theirs.nextDouble() for _ in range(301)]
    assert len(lockstep.draws(start, 0)) == 0


def test_a_search_needs_few_jobs_and_scores_as_single_fits(spark):
    rows = on_folds(spark).select("id", "query", "a", "b", "c", "relevance")
    search = {"group": "query", "label": "relevance", "folds": 2, "trials": 3, "parallelism": 2, "seed": 3, "maxIter": 3}
    last_job = lambda: max(spark.sparkContext.statusTracker().getJobIdsForGroup())
    found, jobs = {}, {}
    # A column subset is beyond the fits grown side by side; "all" changes nothing else.
    for name, more in (("together", {}), ("single", {"featureSubsetStrategy": "all"})):
        spark.range(1).count()
        before = last_job()
        found[name] = [(r["setting"], r["ndcg"]) for r in training.tune_ranker(rows, ["id"], **search, **more).trials.orderBy("trial").collect()]
        jobs[name] = last_job() - before
    assert 2 * jobs["together"] < jobs["single"]
    assert [s for s, _ in found["together"]] == [s for s, _ in found["single"]] and len(found["together"]) == 3
    assert [v for _, v in found["together"]] == pytest.approx([v for _, v in found["single"]], abs=1e-12)


def test_random_trials_come_at_once():
    seen = []

    def scores(settings):
        seen.append(len(settings))
        return [s["x"] for s in settings]

    space = {"x": search.Range(0.0, 1.0)}
    together = search.batched_search(space, scores, 18, 1, 4)
    assert seen == [12, 4, 2] and together == search.adaptive_search(space, lambda s: s["x"], 18, 1, 4)


def test_documents_are_counted_before_they_are_joined(spark):
    from checks.queries import _document_features

    plan = _document_features(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    above, _, below = plan.partition("Join")
    assert "regexp_replace" in below and "regexp_replace" not in above
