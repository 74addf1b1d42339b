"""Keyword cleaning, comment batches, summaries and keyword clusters."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.operators.running import running_sums
from shelfsight.schemas import with_fields
from shelfsight.settings import HOT_ROWS

# The stop words, the words kept in any case, the summary prompt.
STOP_WORDS = ("a", "an", "and", "or", "the", "to", "with", "for")
KEPT_WORDS = ("amazon", "prime")
PROMPT_HEAD = (
    "You are preparing concise summaries for the customer feedback review.\n"
    "Summarise the key themes and actionable points from the following comments:\n"
)
PROMPT_TAIL = "\n\nFormat the answer as bullet points grouped by theme."

# Unicode white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

Batches = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def trimmed(text: Column) -> Column:
    """Strip all surrounding white space, not only blanks."""
    return F.trim(text, F.lit(WHITE_SPACE))


def clean_keywords(
    df: DataFrame, keyword: str, order: Sequence[str], scope: Sequence[str] = ()
) -> DataFrame:
    """Distinct keywords per scope, ignoring case: the first spelling and its place.

    Blanks and stop words go, kept words stay. `order` columns say which spelling
    came first; the minimum is combined on the map side, so a word that makes up
    a third of the rows costs each task one row.
    """
    word = trimmed(F.col(keyword))
    rows = df.select(*scope, word.alias("keyword"), F.struct(*order).alias("_place"))
    rows = rows.withColumn("keyword_key", F.lower("keyword")).where(F.col("keyword") != "")
    stops = [w for w in STOP_WORDS if w not in KEPT_WORDS]
    rows = rows.where(~F.col("keyword_key").isin(stops))
    first = rows.groupBy(*scope, "keyword_key").agg(
        F.min(F.struct(F.col("_place"), F.col("keyword"))).alias("_first")
    )
    places = [F.col(f"_first._place.`{c}`").alias(f"first_{c}") for c in order]
    return first.select(*scope, "keyword_key", F.col("_first.keyword").alias("keyword"), *places)


def clean_keyword_array(keywords: Column) -> Column:
    """Trimmed, non-blank entries of a request's keyword list."""
    return F.filter(F.transform(keywords, trimmed), lambda k: F.coalesce(k != "", F.lit(False)))


def comment_batches(
    comments: DataFrame,
    text: str,
    order: Sequence[str],
    batch_size: int = 10,
    by: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Consecutive batches of comments per key with their prompt.

    Positions are running sums, so one key may hold any number of comments; a
    batch itself gathers at most `batch_size` rows.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be a positive integer")
    by = list(by)
    rows = comments.select(*by, *[c for c in order if c not in by], F.col(text).alias("_text"))
    numbered = running_sums(rows, by, [F.col(c).asc() for c in order], {"_pos": F.lit(1)}, hot_rows)
    index = F.floor((F.col("_pos") - 1) / batch_size).alias("batch_index")
    batched = numbered.groupBy(*by, index).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_text"))), lambda c: c["_text"]).alias("comments")
    )
    bullets = F.array_join(F.transform("comments", lambda c: F.concat(F.lit("- "), c)), "\n")
    return batched.withColumn("prompt", F.concat(F.lit(PROMPT_HEAD), bullets, F.lit(PROMPT_TAIL)))


def offline_summary(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Stand-in generator: the first line of each comment of the batch."""
    for frame in frames:
        lines = frame["comments"].map(lambda cs: "\n".join(f"- {(c.splitlines() or [''])[0]}" for c in cs))
        yield frame.assign(summary=lines.str.strip(), model="offline")


def summarise_batches(batches: DataFrame, generate: Batches = offline_summary) -> DataFrame:
    """Add `summary` and `model` to each batch with a generator over Arrow batches."""
    return batches.mapInPandas(generate, with_fields(batches, summary="string", model="string"))


def summary_documents(summaries: DataFrame, by: Sequence[str] = (), batch_size: int = 10) -> DataFrame:
    """Rows for the summary JSON sink: one document line per batch, with its run facts."""
    return summaries.select(
        *by,
        F.col("batch_index"),
        F.lit(batch_size).alias("batch_size"),
        "comments",
        "prompt",
        F.trim("summary").alias("summary"),
        "model",
    )


def write_text_report(df: DataFrame, root: str, report_date: str, name: str) -> None:
    """JSON lines below root/report_date=YYYYMMDD/name."""
    df.write.mode("overwrite").json(f"{root}/report_date={report_date}/{name}")


def embed_keywords(keywords: DataFrame, embed: Batches, column: str = "embedding") -> DataFrame:
    """Add an embedding column with an embedder over Arrow batches."""
    return keywords.mapInPandas(embed, with_fields(keywords, **{column: "array<double>"}))


@dataclass
class KeywordClusters:
    """Lazy cluster outputs."""

    members: DataFrame
    centroids: DataFrame
    k: int


def cluster_vectors(
    vectors: DataFrame, column: str = "embedding", num_clusters: int = 5, max_iter: int = 50, seed: int = 42
) -> KeywordClusters:
    """K-means over an embedding column, with at most one cluster per vector.

    The distributed estimator seeds its own centres, so cluster numbers are not
    comparable between runs of different engines; memberships are.
    """
    sizes = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size(column)).alias("low"), F.max(F.size(column)).alias("high")
    ).first()
    if not sizes["n"]:
        raise ValueError("no vectors to cluster")
    if sizes["low"] != sizes["high"] or sizes["low"] <= 0:
        raise ValueError("embeddings must all have the same length")
    k = min(num_clusters, sizes["n"])
    ready = vectors.withColumn("_features", array_to_vector(F.col(column).cast("array<double>")))
    if k == 1:
        # The estimator needs two clusters; with one, every vector belongs to it.
        members = vectors.withColumn("cluster_id", F.lit(0))
    else:
        model = KMeans(
            featuresCol="_features", predictionCol="cluster_id", k=k, maxIter=max_iter, seed=seed
        ).fit(ready)
        members = model.transform(ready).drop("_features")
    return KeywordClusters(members, centroids(members, column), k)


def centroids(members: DataFrame, column: str = "embedding") -> DataFrame:
    """Mean vector and size of each cluster, summed per dimension on the map side."""
    cells = members.select("cluster_id", F.posexplode(column).alias("dim", "x"))
    means = cells.groupBy("cluster_id", "dim").agg(F.avg("x").alias("x"), F.count("x").alias("n"))
    # One row per dimension: the vector length bounds what is gathered.
    return means.groupBy("cluster_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "x"))), lambda c: c["x"]).alias("centroid"),
        F.max("n").alias("keyword_count"),
    )
