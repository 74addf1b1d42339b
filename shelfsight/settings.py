"""Tunable settings, with the defaults the daily jobs run on."""

from __future__ import annotations

from dataclasses import dataclass, field

# Score weights, rank cut-off and validity limits.
SCORE_WEIGHTS = {
    "bsr_trend_30": 0.35,
    "est_sales_30": 0.25,
    "review_vel_14": 0.20,
    "price_vol_30": -0.10,
    "listing_quality": 0.30,
}
RANK_MIN = 20
BSR_LIMIT = 5_000_000
ROLLING_WINDOWS = (7, 14, 30)
MIN_PERIOD_SHARE = 0.7

# Groups up to this many rows are sorted by one task; larger ones are cut into
# range slices (see operators/running.py).
HOT_ROWS = 4_000_000
# Rows of a table that one task sorts or aggregates by key. Adaptive execution merges
# partitions by their compressed size, which says little of the memory they need.
TASK_ROWS = 250_000
# Rows of one task in a loop of many short jobs over the same rows.
LOOP_ROWS = 20_000
# Slices of hot groups are not cut smaller than this many rows, where there are more than a few slices.
SLICE_ROWS = 100_000
FEW_SLICES = 200

# Days before and after a label's day, and the splits in time order.
LABEL_SPAN = (28, 30)
SPLIT_SHARES = {"train": 0.7, "valid": 0.15, "test": 0.15}


@dataclass(frozen=True)
class LabelThresholds:
    """Cut-offs of the binary target (fixed values)."""

    sales_ratio: float = 1.6
    percentile_drop: float = 0.2
    rank_gain: float = 1.0


@dataclass(frozen=True)
class AlertLimits:
    """Alert thresholds (fixed values)."""

    data_quality: float = 0.97
    accuracy: float = 0.75
    drift: float = 0.2
    sla_minutes: float = 90.0


@dataclass(frozen=True)
class ReportSettings:
    """Weekly report settings (fixed values)."""

    max_top_candidates: int = 100
    anomaly_z: float = 2.5
    ai_enabled: bool = False
    summary_label: str = "AI 摘要"
    keywords_label: str = "AI 关键词"
    placeholder: str = "待运营审核"


@dataclass(frozen=True)
class ScoringSettings:
    """Batch scoring settings (fixed values)."""

    price_band_column: str = "price_band"
    identifier_columns: tuple[str, ...] = ("asin", "site", "dt", "category", "price_band")
    group_by_columns: tuple[str, ...] = ("site", "category", "price_band")
    rank_min: int = RANK_MIN
    model_version: str = "rank-linear"
    top_contributors: int = 5
    weights: dict[str, float] = field(default_factory=lambda: dict(SCORE_WEIGHTS))
