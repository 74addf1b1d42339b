"""Listwise gradient boosting for rankings: lambda gradients by DataFrame functions, one Spark ML tree a round.

Within a group every pair of rows with different relevance pulls them apart, weighted by
how much NDCG their exchange would change. Positions beyond the `top` places carry no
discount, so only pairs with a row in the first `top` places have a weight: a group is
never ordered as a whole (each map task passes on its first `top` rows), and no pair of
other rows is looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.sources.scratch import materialize, materialize_for_loop

#: Rounds after which the scores are written, so that a lost executor costs at most so many.
WRITE_EVERY = 10


@dataclass(frozen=True)
class Boosting:
    """Settings of a listwise fit; rounds, step, leaves' rows, draw share and patience are the source's."""

    maxIter: int = 1000
    patience: int = 50
    stepSize: float = 0.05
    maxDepth: int = 6
    minInstancesPerNode: int = 20
    subsamplingRate: float = 0.8
    top: int = 30
    judged: int = 20
    seed: int = 42


def _discount(place: Column) -> Column:
    return 1 / F.log2(place + 1)


def first_places(rows: DataFrame, by: Column, top: int, *columns: str) -> DataFrame:
    """`columns` of the first `top` rows of each `_group` by falling `by`, with `place` from 1 on; ties by `_row`."""
    order = Window.partitionBy("_group").orderBy(by.desc(), F.col("_row").asc())
    placed = rows.select("_group", "_row", *columns).withColumn("place", F.row_number().over(order))
    return placed.where(F.col("place") <= top)


def ideal(rows: DataFrame, top: int) -> DataFrame:
    """`_group`, `best`: the largest DCG@top that the group's gains allow."""
    placed = first_places(rows, F.col("_gain"), top, "_gain")
    return placed.groupBy("_group").agg(F.sum(F.col("_gain") * _discount(F.col("place"))).alias("best"))


def ndcg(rows: DataFrame, best: DataFrame, top: int) -> float:
    """Mean NDCG@top over groups; a group without relevant rows counts as 0."""
    found = first_places(rows, F.col("_score"), top, "_gain", "_score")
    found = found.groupBy("_group").agg(F.sum(F.col("_gain") * _discount(F.col("place"))).alias("dcg"))
    value = F.coalesce(F.try_divide("dcg", "best"), F.lit(0.0))
    return float(found.join(best, "_group").agg(F.avg(value)).first()[0] or 0.0)


def lambda_gradients(rows: DataFrame, best: DataFrame, top: int) -> DataFrame:
    """Add `_grad` and `_hess`, the sums over a row's pairs of NDCG change times the logistic slope.

    `rows` holds _group, _row (unique), _gain, _score. Every row meets its group's first
    places, joined as one array of at most `top` entries. A pair is computed once and gives
    a part to the row and, where the row is behind the first places, to the other one; the
    parts are summed before they are shuffled.
    """
    entry = F.struct("place", "_row", "_gain", "_score")
    leaders = first_places(rows, F.col("_score"), top, "_gain", "_score")
    leaders = leaders.groupBy("_group").agg(F.sort_array(F.collect_list(entry)).alias("_top"))
    leaders = leaders.join(best.where("best > 0"), "_group")
    joined = rows.select("_group", "_row", "_gain", "_score").join(leaders, "_group")
    # The array is in order of place. Its pairs are exploded: array functions are interpreted.
    place = F.array_position(F.col("_top")["_row"], F.col("_row"))
    pairs = joined.withColumn("_place", F.nullif(place, F.lit(0))).withColumn("t", F.explode("_top")).drop("_top")
    mine = F.coalesce(_discount(F.col("_place")), F.lit(0.0))
    ahead = F.signum(F.col("_gain") - F.col("t._gain"))
    change = F.abs(F.col("_gain") - F.col("t._gain")) * F.abs(mine - _discount(F.col("t.place"))) / F.col("best")
    slope = 1 / (1 + F.exp(ahead * (F.col("_score") - F.col("t._score"))))
    pairs = pairs.withColumns({"_g": ahead * slope * change, "_h": slope * (1 - slope) * change})
    own = F.struct(F.col("_row").alias("_row"), F.col("_g").alias("g"), F.col("_h").alias("h"))
    back = F.struct(F.col("t._row").alias("_row"), (-F.col("_g")).alias("g"), F.col("_h").alias("h"))
    parts = pairs.select("_group", F.explode(F.array(own, F.when(F.col("_place").isNull(), back))).alias("p")).where("p is not null")
    sums = parts.groupBy("_group", F.col("p._row").alias("_row")).agg(F.sum("p.g").alias("_grad"), F.sum("p.h").alias("_hess"))
    return rows.join(sums, ["_group", "_row"])


def ensemble(trees: list[DecisionTreeRegressionModel], step: float, features: str, width: int) -> GBTRegressionModel:
    """The trees as one Spark ML model whose prediction is their sum times `step`."""
    spark = trees[0]._java_obj  # the models live in the session's JVM
    from pyspark import SparkContext

    gateway = SparkContext._active_spark_context._gateway
    held = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for k, tree in enumerate(trees):
        held[k], weights[k] = tree._java_obj, float(step)
    made = gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(f"listwise_{spark.uid()}", held, weights, width)
    return GBTRegressionModel(made).setFeaturesCol(features)


def fit_listwise(
    rows: DataFrame, group: str, label: str, held: str, features: str, settings: Boosting | None = None, weight: str | None = None
) -> GBTRegressionModel:
    """Boost trees on lambda gradients of the rows not `held`; stop when NDCG of the held ones has not risen.

    `rows` has the feature vector, the group (null is a group), the relevance (its gain is
    2^relevance - 1; null counts as 0) and the flag `held`. Every round fits one tree to
    gradient / curvature, weighted by curvature, so that a leaf's value is the Newton step
    of its rows. Without held-out rows all rounds run. Starts Spark jobs.
    """
    s = settings or Boosting()
    key = F.to_json(F.struct(F.col(group).alias("g")))
    gain = F.pow(F.lit(2.0), F.coalesce(F.col(label).cast("double"), F.lit(0.0))) - 1
    scale = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)) if weight else F.lit(1.0)
    base = rows.select(
        key.alias("_group"), F.monotonically_increasing_id().alias("_row"), gain.alias("_gain"), F.col(held).alias("_held"),
        scale.alias("_scale"), F.col(features).alias("_x"),
    )
    # A round is some twenty short jobs: all of them run on as few tasks as the rows need.
    state = materialize_for_loop(base.withColumn("_score", F.lit(0.0)), "boost")
    width = state.where("_x is not null").select("_x").first()
    width = len(width["_x"]) if width else 0
    best = materialize(ideal(state.where("not _held"), s.top), "ideal")
    best_held = materialize(ideal(state.where("_held"), s.judged), "ideal")
    learner = DecisionTreeRegressor(
        featuresCol="_x", labelCol="_step", weightCol="_weight", predictionCol="_tree", maxDepth=s.maxDepth,
        minInstancesPerNode=s.minInstancesPerNode, seed=s.seed,
    )
    judged = not best_held.isEmpty()
    trees: list[DecisionTreeRegressionModel] = []
    kept, highest, cached = 0, -1.0, None
    scored, written = state, 0
    for number in range(s.maxIter):
        drawn = F.pmod(F.xxhash64("_row", F.lit(s.seed), F.lit(number)), F.lit(1 << 20)) < s.subsamplingRate * (1 << 20)
        sloped = lambda_gradients(scored.where("not _held"), best, s.top).where(drawn & (F.col("_hess") * F.col("_scale") > 1e-12))
        steps = sloped.select("_x", (F.col("_grad") / F.col("_hess")).alias("_step"), (F.col("_hess") * F.col("_scale")).alias("_weight"))
        steps = steps.persist()
        if steps.isEmpty():
            steps.unpersist()
            break
        tree = learner.fit(steps)
        steps.unpersist()
        trees.append(tree)
        # One model of the trees since the last writing keeps the plan as short as the first round's.
        recent = ensemble(trees[written:], s.stepSize, "_x", width).setPredictionCol("_tree")
        moved = recent.transform(state).withColumn("_score", F.col("_score") + F.col("_tree")).drop("_tree")
        if len(trees) - written == WRITE_EVERY:
            state, fresh, written = materialize(moved, "boost"), None, len(trees)
            moved = state
        else:
            moved = fresh = moved.persist()
        reached = ndcg(moved.where("_held"), best_held, s.judged) if judged else float(len(trees))
        if cached is not None:
            cached.unpersist()
        scored, cached = moved, fresh
        if reached > highest:
            kept, highest = len(trees), reached
        elif len(trees) - kept >= s.patience:
            break
    if cached is not None:
        cached.unpersist()
    if not trees:
        raise ValueError("no two rows of a group differ in relevance")
    return ensemble(trees[:kept], s.stepSize, features, width)
