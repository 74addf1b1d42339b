"""Classifier, regressor and ranker training on Spark ML."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Any, NamedTuple

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.operators import lockstep
from shelfsight.operators.boosting import Boosting, fit_listwise
from shelfsight.operators.metrics import (
    binary_metrics,
    lift_curve,
    ranking_metrics,
    regression_metrics,
)
from shelfsight.operators.search import Range, adaptive_search, batched_search
from shelfsight.operators.splits import group_folds, group_holdout, random_holdout, stratified_holdout
from shelfsight.schemas import first_present, numeric_columns
from shelfsight.sources.scratch import materialize, materialize_for_loop

# Column names looked for when none is given, and the cut-offs reported.
GROUP_CANDIDATES = ("group_id", "query", "query_id", "asin", "item_group")
LABEL_CANDIDATES = ("y_rank", "label", "target", "relevance")
RANK_KS = (5, 10, 20, 50)

FEATURES, WEIGHT, HELD = "_features", "_weight", "is_validation"
TREE_MODELS = ("gbt", "forest")
# The source's rounds and step; boosting stops early on the held-out rows.
FULL_RUNS: dict[str, dict[str, Any]] = {"gbt": {"maxIter": 500, "stepSize": 0.05}, "forest": {"numTrees": 500}, "linear": {}}

CLASSIFIERS: dict[str, Callable[..., Estimator]] = {
    "gbt": GBTClassifier,
    "forest": RandomForestClassifier,
    "linear": LogisticRegression,
}
REGRESSORS: dict[str, Callable[..., Estimator]] = {
    "gbt": GBTRegressor,
    "forest": RandomForestRegressor,
    "linear": LinearRegression,
}


@dataclass
class TrainedModel:
    """A fitted model with its lazy result tables."""

    model: PipelineModel
    features: list[str]
    metrics: DataFrame
    importances: DataFrame
    predictions: DataFrame
    lift: DataFrame | None = None


def class_balance(df: DataFrame, target: str) -> float | None:
    """negatives / positives, or None when a class is empty."""
    row = df.agg(F.count_if(F.col(target) == 1).alias("pos"), F.count_if(F.col(target) == 0).alias("neg")).first()
    return row["neg"] / row["pos"] if row["pos"] and row["neg"] else None


def feature_columns(df: DataFrame, exclude: Sequence[str]) -> list[str]:
    """Numeric columns left after `exclude`; an error if there are none."""
    names = numeric_columns(df, tuple(exclude))
    if not names:
        raise ValueError("no numeric features available for training")
    return names


def _assembly(features: list[str]) -> list[Estimator]:
    """Missing values to the column mean (no Spark ML learner takes them), then one vector."""
    filled = [f"_filled_{c}" for c in features]
    return [
        Imputer(inputCols=features, outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=filled, outputCol=FEATURES),
    ]


def _as_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def importance_table(spark: SparkSession, model: Model, features: list[str]) -> DataFrame:
    """(feature, gain, split), by falling gain; absolute coefficients for linear models.

    `split` counts the tree nodes that test the feature (tree ensembles only).
    """
    if hasattr(model, "featureImportances"):
        gains = model.featureImportances.toArray().tolist()
        tests = model.toDebugString
        splits = [tests.count(f"If (feature {i} ") for i in range(len(features))]
    else:
        gains = [abs(c) for c in model.coefficients.toArray().tolist()]
        splits = [None] * len(features)
    rows = list(zip(features, gains, splits))
    table = spark.createDataFrame(rows, "feature string, gain double, split int")
    return table.orderBy(F.col("gain").desc(), F.col("feature").asc())


def _fit(estimators: dict, kind: str, label: str, options: dict[str, Any], **extra) -> Estimator:
    if kind not in estimators:
        raise ValueError(f"unsupported model type: {kind}")
    return estimators[kind](featuresCol=FEATURES, labelCol=label, **extra, **(FULL_RUNS[kind] | options))


def _fit_pipeline(rows: DataFrame, features: list[str], learner: Estimator, watches: bool) -> PipelineModel:
    """Means and model from the training rows; a learner that `watches` also sees the held-out ones.

    Boosting needs them to know when to stop, but no column mean may come from them.
    """
    training = rows.where(~F.col(HELD))
    assembly = Pipeline(stages=_assembly(features)).fit(training)
    model = learner.fit(assembly.transform(rows if watches else training))
    return PipelineModel([*assembly.stages, model])


def train_classifier(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    kind: str = "gbt",
    drop: Sequence[str] = (),
    fraction: float = 0.2,
    seed: int = 42,
    **options: Any,
) -> TrainedModel:
    """Stratified split, class-weighted fit, metrics of both parts and predictions.

    Boosting stops early on the held-out rows. The prepared rows are written once,
    since every boosting round passes over them.
    """
    if target not in df.columns:
        raise KeyError(f"target column {target!r} not found")
    features = feature_columns(df, [target, *keys, *drop])
    rows = stratified_holdout(df.select(*keys, target, *features), target, keys, fraction, seed)
    rows = _as_double(rows, [*features, target])
    balance = class_balance(rows.where(~F.col(HELD)), target) or 1.0
    rows = materialize(rows.withColumn(WEIGHT, F.when(F.col(target) == 1, balance).otherwise(1.0)), "train")
    extra: dict[str, Any] = {"weightCol": WEIGHT}
    if kind in TREE_MODELS:
        extra["seed"] = seed
    if kind == "gbt":
        extra["validationIndicatorCol"] = HELD
    model = _fit_pipeline(rows, features, _fit(CLASSIFIERS, kind, target, options, **extra), kind == "gbt")
    scored = model.transform(rows).select(
        *keys, HELD, F.col(target).alias("label"), vector_to_array("probability")[1].alias("prediction")
    )
    parts = {"train": scored.where(~F.col(HELD)), "validation": scored.where(F.col(HELD))}
    metrics = _by_part({p: binary_metrics(d, "label", "prediction") for p, d in parts.items()})
    table = importance_table(df.sparkSession, model.stages[-1], features)
    return TrainedModel(model, features, metrics, table, parts["validation"].drop(HELD))


def _by_part(tables: dict[str, DataFrame]) -> DataFrame:
    (first_name, first), *others = tables.items()
    out = first.select(F.lit(first_name).alias("part"), "*")
    for name, table in others:
        out = out.unionByName(table.select(F.lit(name).alias("part"), "*"))
    return out


def train_regressor(
    df: DataFrame,
    target: str,
    keys: Sequence[str],
    kind: str = "gbt",
    drop: Sequence[str] = (),
    fraction: float = 0.2,
    seed: int = 42,
    **options: Any,
) -> TrainedModel:
    """Random split, fit, metrics of both parts and predictions."""
    if target not in df.columns:
        raise KeyError(f"target column {target!r} not found")
    features = feature_columns(df, [target, *keys, *drop])
    rows = random_holdout(df.select(*keys, target, *features), keys, fraction, seed)
    rows = materialize(_as_double(rows, [*features, target]), "train")
    extra: dict[str, Any] = {"seed": seed} if kind in TREE_MODELS else {}
    if kind == "gbt":
        extra["validationIndicatorCol"] = HELD
    model = _fit_pipeline(rows, features, _fit(REGRESSORS, kind, target, options, **extra), kind == "gbt")
    scored = model.transform(rows).select(*keys, HELD, F.col(target).alias("label"), "prediction")
    parts = {"train": scored.where(~F.col(HELD)), "validation": scored.where(F.col(HELD))}
    metrics = _by_part({p: regression_metrics(d, "label", "prediction") for p, d in parts.items()})
    table = importance_table(df.sparkSession, model.stages[-1], features)
    return TrainedModel(model, features, metrics, table, parts["validation"].drop(HELD))


def train_ranker(
    df: DataFrame,
    keys: Sequence[str],
    group: str | None = None,
    label: str | None = None,
    baseline: str | None = None,
    weight: str | None = None,
    kind: str = "listwise",
    drop: Sequence[str] = (),
    fraction: float = 0.2,
    seed: int = 42,
    ks: Sequence[int] = RANK_KS,
    **options: Any,
) -> TrainedModel:
    """Ranker judged by ranking metrics per group; whole groups are held out.

    `listwise` boosts trees on lambda gradients and stops on the held-out groups' NDCG;
    its options are those of `Boosting`. The other kinds regress on the relevance alone.
    """
    group = first_present(df, GROUP_CANDIDATES, group)
    label = first_present(df, LABEL_CANDIDATES, label)
    features = feature_columns(df, [label, group, *keys, *drop, *([weight] if weight else [])])
    kept = dict.fromkeys([*keys, group, label, *features, *([baseline] if baseline else []), *([weight] if weight else [])])
    rows = _as_double(group_holdout(df.select(*kept), group, fraction, seed), [*features, label])
    rows = materialize(rows, "train")
    extra: dict[str, Any] = {"seed": seed} if kind in TREE_MODELS else {}
    if weight:
        extra["weightCol"] = weight
    if kind == "gbt":
        extra["validationIndicatorCol"] = HELD
    if kind == "listwise":
        assembly = Pipeline(stages=_assembly(features)).fit(rows.where(~F.col(HELD)))
        settings = Boosting(**({"seed": seed} | options))
        ranker = fit_listwise(assembly.transform(rows), group, label, HELD, FEATURES, settings, weight)
        model = PipelineModel([*assembly.stages, ranker])
    else:
        model = _fit_pipeline(rows, features, _fit(REGRESSORS, kind, label, options, **extra), kind == "gbt")
    scored = model.transform(rows.where(F.col(HELD))).select(
        *dict.fromkeys([*keys, group, *([baseline] if baseline else [])]),
        F.col(label).alias("label"),
        "prediction",
    )
    metrics = ranking_metrics(scored, group, "label", "prediction", baseline, ks, keys)
    lift = lift_curve(scored, group, "label", "prediction", baseline, ks, keys) if baseline else None
    table = importance_table(df.sparkSession, model.stages[-1], features)
    return TrainedModel(model, features, metrics, table, scored, lift)


# Search ranges of the boosted ranker.
SEARCH_SPACE: dict[str, Range] = {
    "stepSize": Range(0.01, 0.2, log=True),
    "maxDepth": Range(3, 7, whole=True),
    "minInstancesPerNode": Range(10, 100, whole=True),
    "subsamplingRate": Range(0.5, 1.0),
}


class TunedRanker(NamedTuple):
    """The best setting, all trials, and the best setting's model fitted on all rows."""

    best: dict[str, Any]
    trials: DataFrame
    model: PipelineModel


def _mean_ndcg(scored: DataFrame, group: str, label: str, tie: Sequence[str], k: int = 20) -> float:
    metrics = ranking_metrics(scored, group, label, "prediction", ks=(k,), tie=tie)
    return float(metrics.where(F.col("metric") == f"ndcg@{k}").first()["value"] or 0.0)


def prepared_folds(rows: DataFrame, features: list[str], folds: int) -> list[DataFrame]:
    """For each fold all rows with their vectors, written once; missing values are means of the other folds' rows."""
    out = []
    for fold in range(folds):
        held = rows.withColumn(HELD, F.col("fold") == fold)
        assembly = Pipeline(stages=_assembly(features)).fit(held.where(~F.col(HELD)))
        out.append(materialize_for_loop(assembly.transform(held).drop(*[f"_filled_{c}" for c in features]), "fold"))
    return out


def _side_by_side(
    prepared: list[DataFrame], learner: Callable[[dict[str, Any]], GBTRegressor], group: str, label: str, keys: Sequence[str], parallelism: int
) -> Callable[[list[dict[str, Any]]], list[float]]:
    """The mean NDCG@20 over the folds of several settings at once: all their fits are grown and judged together."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        folds = list(pool.map(lambda part: lockstep.prepare(part.where(~F.col(HELD)), learner({})), prepared))
    held = [part.where(F.col(HELD)).select(*dict.fromkeys([*keys, group, label]), FEATURES) for part in prepared]

    def scores(settings: list[dict[str, Any]]) -> list[float]:
        values = [lockstep.setting(learner(s)) for s in settings]
        fits = lockstep.fit(folds, values)
        judged = None
        for f, (fold, rows) in enumerate(zip(folds, held)):
            own = lockstep.score(rows, FEATURES, fold.borders, values, [of[f] for of in fits]).withColumn("_fold", F.lit(f))
            judged = own if judged is None else judged.unionByName(own)
        by = ["_fit", "_fold"]
        metrics = ranking_metrics(materialize(judged, "trial"), group, label, "prediction", ks=(20,), tie=keys, by=by)
        found = {(r["_fit"], r["_fold"]): float(r["value"] or 0.0) for r in metrics.where("metric = 'ndcg@20'").collect()}
        return [sum(found.get((k, f), 0.0) for f in range(len(folds))) / len(folds) for k in range(len(values))]

    return scores


def tune_ranker(
    df: DataFrame,
    keys: Sequence[str],
    group: str | None = None,
    label: str | None = None,
    folds: int = 3,
    trials: int = 50,
    drop: Sequence[str] = (),
    seed: int = 42,
    parallelism: int = 4,
    space: dict[str, Range] | None = None,
    **options: Any,
) -> TunedRanker:
    """Adaptive search for the setting with the best mean NDCG@20 over group folds."""
    group = first_present(df, GROUP_CANDIDATES, group)
    label = first_present(df, LABEL_CANDIDATES, label)
    features = feature_columns(df, [label, group, *keys, *drop])
    rows = group_folds(df.select(*dict.fromkeys([*keys, group, label, *features])), group, folds, seed)
    rows = materialize(_as_double(rows, [*features, label]), "tune")
    prepared = prepared_folds(rows, features, folds)

    def learner(setting: dict[str, Any]) -> GBTRegressor:
        return GBTRegressor(featuresCol=FEATURES, labelCol=label, seed=seed, **(options | setting))

    def fold_score(setting: dict[str, Any], part: DataFrame) -> float:
        model = learner(setting).fit(part.where(~F.col(HELD)))
        return _mean_ndcg(model.transform(part.where(F.col(HELD))), group, label, keys)

    if lockstep.supports(options, space or SEARCH_SPACE):
        scores = _side_by_side(prepared, learner, group, label, keys, max(parallelism, 1))
        tried = batched_search(space or SEARCH_SPACE, scores, trials, seed, parallelism)
    else:
        # The folds of a trial do not wait for each other either: a fit is a chain of short jobs.
        with ThreadPoolExecutor(max_workers=max(parallelism, 1) * folds) as pool:

            def score(setting: dict[str, Any]) -> float:
                found = list(pool.map(lambda part: fold_score(setting, part), prepared))
                return sum(found) / len(found)

            tried = adaptive_search(space or SEARCH_SPACE, score, trials, seed, parallelism)
    best = max(tried, key=lambda t: t[1])[0]
    table = [(i, m, {n: float(v) for n, v in setting.items()}) for i, (setting, m) in enumerate(tried)]
    trials_table = df.sparkSession.createDataFrame(table, "trial int, ndcg double, setting map<string,double>")
    assembly = Pipeline(stages=_assembly(features)).fit(rows)
    model = PipelineModel([*assembly.stages, learner(best).fit(assembly.transform(rows))])
    return TunedRanker(best, trials_table, model)
