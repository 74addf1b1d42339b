"""The daily job: raw rows to mart, features and scores."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from shelfsight.operators.features import build_features
from shelfsight.operators.scoring import score
from shelfsight.operators.standardize import standardize
from shelfsight.settings import RANK_MIN


@dataclass
class DailyTables:
    """Lazy tables of one daily run."""

    mart: DataFrame
    features: DataFrame
    scores: DataFrame


def daily_run(
    raw: DataFrame,
    categories: DataFrame,
    tie_break: tuple[str, ...] = (),
    rank_min: int = RANK_MIN,
) -> DailyTables:
    """One lazy plan from raw deliveries to ranked scores.

    Days are cut before deduplication, so a product has one row per day and the
    feature windows stay as short as the calendar. `categories` holds one
    category per (asin, site).
    """
    mart = standardize(raw, dedup_on="date", tie_break=tie_break)
    features = build_features(mart, daily=True)
    grouped = features.join(categories.select("asin", "site", "category"), ["asin", "site"], "left")
    return DailyTables(mart, features, score(grouped, rank_min=rank_min))
