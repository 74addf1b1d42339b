"""Robust-z baseline score and its rank per site and category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.columns import null_safe_join, number
from shelfsight.operators.running import top_ranks
from shelfsight.operators.selection import group_medians
from shelfsight.schemas import ensure_columns
from shelfsight.settings import RANK_MIN, SCORE_WEIGHTS
from shelfsight.sources.scratch import materialize

GROUP = ["site", "category"]
# A higher volatility lowers the score's z.
INVERTED = "price_vol_30"


def robust_stats(df: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """Add `<column>_med` and `<column>_mad` (1e-9 where the spread is zero).

    The statistics are written before they are joined back: as files their true
    size is known, so the rows are shuffled only if there are very many groups.
    """
    centre = group_medians(df.select(*by, *columns), by, columns)
    centre = materialize(centre.withColumnsRenamed({c: f"{c}_med" for c in columns}), "medians")
    centred = null_safe_join(df, centre, by)
    distance = centred.select(*by, *[F.abs(F.col(c) - F.col(f"{c}_med")).alias(c) for c in columns])
    spread = group_medians(distance, by, columns)
    spread = spread.select(
        *by, *[F.when(F.col(c) == 0, 1e-9).otherwise(F.col(c)).alias(f"{c}_mad") for c in columns]
    )
    return null_safe_join(centred, materialize(spread, "spreads"), by)


def score(
    features: DataFrame,
    weights: dict[str, float] | None = None,
    rank_min: int = RANK_MIN,
    keep_z: bool = False,
) -> DataFrame:
    """Weighted robust z-score over each (site, category), all dates together.

    A missing z leaves the score, and so the rank, missing. The group statistics
    are tiny and joined back by measured size; ranks above `rank_min` are NULL.
    """
    weights = weights or SCORE_WEIGHTS
    metrics = list(weights)
    rows = ensure_columns(
        features,
        {"asin": "string", "site": "string", "dt": "date", "category": "string"}
        | {m: "double" for m in metrics},
    ).select("asin", "site", "dt", "category", *[number(m).alias(m) for m in metrics])
    # Medians, spreads and scores each pass over these few columns: write them once.
    rows = materialize(rows, "score-input")
    rows = robust_stats(rows, GROUP, metrics)
    z = {}
    for m in metrics:
        value = (F.col(m) - F.col(f"{m}_med")) / F.col(f"{m}_mad")
        z[f"z_{m}"] = -value if m == INVERTED else value
    rows = rows.withColumns(z)
    total = sum(F.lit(w) * F.col(f"z_{m}") for m, w in weights.items())
    # The text of the weights is the same for all rows: as a part of its own it is made once.
    fixed = F.to_json(F.struct(*[F.lit(w).alias(m) for m, w in weights.items()]))
    found = F.to_json(F.struct(*[F.col(f"z_{m}").alias(m) for m in metrics]))
    reason = F.concat(F.lit('{"w":'), fixed, F.lit(',"z":'), found, F.lit("}"))
    scored = rows.select("asin", "site", "dt", "category", total.alias("explosive_score"), *z)
    ranked = top_ranks(scored, GROUP, "explosive_score", rank_min, "rank_in_cat")
    # The text is built last, so the rank join moves numbers only.
    return ranked.withColumn("reason", reason).select(
        "asin", "site", "dt", "category", "explosive_score", "reason", *(z if keep_z else ()), "rank_in_cat"
    )
