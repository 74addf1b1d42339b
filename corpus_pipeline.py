"""From raw documents to packed training sequences, in five written stages.

Each stage gets the rows that the one before it kept, as a Parquet table in the
cluster's shared folder, and reads them again, so a lost executor never costs more
than one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfsight.llm import curriculum, exact_dedup, ngram_join, packing, quality_rules
from shelfsight.llm.common import table, tokenizer_file
from shelfsight.sources.scratch import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The near-duplicate search and the tokenizer are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the rows that the quality rules reject."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.keep_one(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the row with the smallest id stays."""
    return ngram_join.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum: rows as often as their source's target takes them, in training order."""
    return curriculum.training_rows(curriculum.curriculum(docs, carry=True))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the mix, packed into sequences."""
    return packing.pack(packing.document_pieces(docs, tokenizer_file("byte_bpe_50k.json"), 0))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("mix_sources", mix),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to documents."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir), name)
    return rows
