"""What each feature adds to a fitted model's score, exact for trees and linear models.

A tree's score is the mean of its root plus, at every split on the way down, the change
of the node mean; the change belongs to the feature that was tested. Sums over the trees
of an ensemble and divides it as the model does, so contributions and base add up to the
score. A linear model adds coefficient x (value - training mean). Classifiers are scored by
log odds (boosted and logistic ones) or by probability (forests and single trees).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.sources.scratch import scratch_path


@dataclass(frozen=True)
class NodeTable:
    """All nodes of an ensemble in one run of arrays; children are places in them, -1 at leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray

    @property
    def base(self) -> float:
        return float(self.value[self.roots].sum())


def _weights(model: Model, trees: int) -> np.ndarray:
    """What a tree's value counts in the score."""
    name = type(model).__name__
    if name.startswith("GBT"):
        # Spark's boosted classifier has margins of half the log odds.
        return np.array(model.treeWeights, dtype=float) * (2.0 if name == "GBTClassificationModel" else 1.0)
    return np.full(trees, 1.0 / trees)


def node_table(model: Model) -> NodeTable:
    """The model's saved nodes, a few thousand rows whatever the data, as arrays."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "model")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    # A single tree is saved without the number of its tree.
    nodes = saved.select("treeID", "nodeData.*") if "treeID" in saved.columns else saved.withColumn("treeID", F.lit(0))
    rows = nodes.select(
        "treeID", "id", "prediction", "impurityStats", "leftChild", "rightChild", F.col("split.featureIndex").alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    ).orderBy("treeID", "id").toArrow()
    tree, number = rows.column("treeID").to_numpy(), rows.column("id").to_numpy()
    trees = int(tree.max()) + 1
    starts = np.searchsorted(tree, np.arange(trees))
    value = rows.column("prediction").to_numpy().copy()
    if "Classification" in type(model).__name__ and not type(model).__name__.startswith("GBT"):
        stats = np.array(rows.column("impurityStats").to_pylist())
        value = stats[:, 1] / stats.sum(axis=1)
    value = value * _weights(model, trees)[tree]
    assert (number == np.arange(len(number)) - starts[tree]).all(), "nodes are numbered without gaps"

    def child(name: str) -> np.ndarray:
        place = rows.column(name).to_numpy()
        return np.where(place < 0, -1, place + starts[tree])

    return NodeTable(
        rows.column("feature").to_numpy(), rows.column("threshold").fill_null(0.0).to_numpy(), child("leftChild"), child("rightChild"),
        value, starts,
    )


def path_contributions(nodes: NodeTable, x: np.ndarray) -> np.ndarray:
    """For rows of feature values: the changes of the node mean, added up by tested feature."""
    out = np.zeros(x.shape)
    rows = np.arange(len(x))
    for root in nodes.roots:
        at, alive = np.full(len(x), root), rows
        while len(alive):
            here = at[alive]
            inner = nodes.left[here] >= 0
            alive, here = alive[inner], here[inner]
            feature = nodes.feature[here]
            below = np.where(x[alive, feature] <= nodes.threshold[here], nodes.left[here], nodes.right[here])
            out[alive, feature] += nodes.value[below] - nodes.value[here]
            at[alive] = below
    return out


def explained(df: DataFrame, pipeline: PipelineModel, features: list[str], score: str, name: str, base: str) -> DataFrame:
    """Add the score, a map of contributions by feature and the base; base and contributions sum to the score.

    `pipeline` is an imputer, an assembler of `features` and a model, as the trainers build
    it. A missing value counts as its imputed mean, so it adds nothing in a linear model.
    The node table is broadcast: its size is the model's.
    """
    *before, model = pipeline.stages
    prepared = PipelineModel(before).transform(df.withColumns({c: F.col(c).cast("double") for c in features}))
    vector = vector_to_array(model.getFeaturesCol())
    if hasattr(model, "coefficients"):
        means = _training_means(before, features)
        weights = [float(w) for w in model.coefficients.toArray()]
        parts = {c: F.lit(w) * (vector[k] - F.lit(means[c])) for k, (c, w) in enumerate(zip(features, weights))}
        start = float(model.intercept) + sum(w * means[c] for c, w in zip(features, weights))
        pairs = [x for c, part in parts.items() for x in (F.lit(c), part)]
        total = F.lit(start) + sum(parts.values())
        return prepared.select(*df.columns, total.alias(score), F.create_map(*pairs).alias(name), F.lit(start).alias(base))
    nodes = node_table(model)
    shared, kept, width = df.sparkSession.sparkContext.broadcast(nodes), df.columns, len(features)

    def explain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("_vector").flatten().to_numpy().reshape(batch.num_rows, width)
            parts = path_contributions(shared.value, x)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width)
            keys = pa.array(features * batch.num_rows, pa.string())
            start = shared.value.base
            columns = [*[batch.column(c) for c in kept], pa.array(start + parts.sum(axis=1))]
            columns += [pa.MapArray.from_arrays(offsets, keys, pa.array(parts.ravel())), pa.array(np.full(batch.num_rows, start))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, score, name, base])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields]
    schema = ", ".join([*fields, f"`{score}` double", f"`{name}` map<string,double>", f"`{base}` double"])
    return prepared.select(*df.columns, vector.alias("_vector")).mapInArrow(explain, schema)


def _training_means(stages: list[Model], features: list[str]) -> dict[str, float]:
    imputer = next(s for s in stages if hasattr(s, "surrogateDF"))
    row = imputer.surrogateDF.first()
    return {c: float(row[c]) for c in features}
