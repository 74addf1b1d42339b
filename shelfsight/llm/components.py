"""Connected components by smallest labels, with tables written between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.sources.scratch import materialize


def components(edges: DataFrame) -> DataFrame:
    """Label every node of the edges (a, b) with the smallest node it is linked to.

    Each round takes the least label of the neighbours, then follows labels of labels,
    so long chains shrink fast. Minima are combined before each shuffle. Returns node
    and label; no edges give no rows. Starts Spark jobs.
    """
    pairs = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    pairs = materialize(pairs, "edges")
    labels = pairs.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels = materialize(labels, "labels")
    while True:
        near = (
            pairs.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        above = lower.select(F.col("node").alias("label"), F.col("label").alias("above"))
        moved = materialize(
            lower.join(above, "label", "left").select("node", "old", F.coalesce("above", "label").alias("label")), "labels"
        )
        labels = moved.select("node", "label")
        if moved.filter("old <> label").isEmpty():
            return labels
