"""Batch scoring with contributions and ranks, and the daily scoring job."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.functions.columns import calendar_date, group_key, number, top_by_size, value_map
from shelfsight.operators.contributions import explained
from shelfsight.operators.running import group_sizes, rank_values, spread_keys, top_ranks
from shelfsight.schemas import ensure_columns, with_fields
from shelfsight.settings import HOT_ROWS, ScoringSettings
from shelfsight.sources.datasets import export_view, load_latest, write_snapshot
from shelfsight.sources.scratch import materialize

logger = logging.getLogger(__name__)

CONTRIBUTIONS = "_contributions"

BASE_FIELDS = {
    "asin": "string",
    "site": "string",
    "dt": "date",
    "category": "string",
    "bsr_trend_30": "double",
    "est_sales_30": "double",
    "review_vel_14": "double",
    "price_vol_30": "double",
    "listing_quality": "double",
}
RECORD_SCHEMA = ", ".join(f"{c} {'string' if c == 'dt' else t}" for c, t in BASE_FIELDS.items())


@dataclass(frozen=True)
class LinearScorer:
    """Linear model with exact contributions coef·(x − mean); missing values sit at the mean."""

    coefficients: Mapping[str, float]
    means: Mapping[str, float] = field(default_factory=dict)
    intercept: float = 0.0

    @property
    def features(self) -> list[str]:
        return list(self.coefficients)

    def __call__(self, df: DataFrame, features: list[str]) -> DataFrame:
        parts: dict[str, Column] = {}
        for name in features:
            mean = F.lit(float(self.means.get(name, 0.0)))
            parts[name] = F.lit(float(self.coefficients[name])) * (F.coalesce(number(name), mean) - mean)
        base = self.intercept + sum(self.coefficients[n] * self.means.get(n, 0.0) for n in features)
        pairs = [x for n, c in parts.items() for x in (F.lit(n), c)]
        return df.withColumns(
            {"lgbm_score": F.lit(float(base)) + sum(parts.values()), CONTRIBUTIONS: F.create_map(*pairs)}
        )


@dataclass(frozen=True)
class PipelineScorer:
    """A fitted Spark ML pipeline (imputer, assembler, model) with exact contributions.

    Classifiers are scored by log odds or probability, as `contributions.explained` says.
    """

    model: PipelineModel
    features: list[str]

    def __call__(self, df: DataFrame, features: list[str]) -> DataFrame:
        return explained(df, self.model, features, "lgbm_score", CONTRIBUTIONS, "_base").drop("_base")


@dataclass(frozen=True)
class PandasScorer:
    """Any Python model: a function from Arrow batches to batches with `lgbm_score`.

    The function may fill the contributions map. It is shipped to the executors
    with what it closes over, so pass a broadcast variable for a large model.
    """

    predict: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]
    features: list[str]

    def __call__(self, df: DataFrame, features: list[str]) -> DataFrame:
        schema = with_fields(df, lgbm_score="double", **{CONTRIBUTIONS: "map<string,double>"})
        return df.mapInPandas(self.predict, schema)


def reason_json(contributions: Column, limit: int = 5) -> Column:
    """JSON object of the largest contributions, largest first."""
    return F.to_json(F.map_from_entries(top_by_size(contributions, limit)))


def score_batch(
    features: DataFrame,
    scorer: LinearScorer | PipelineScorer | PandasScorer,
    settings: ScoringSettings | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Scores, top contributors, group ids and ranks; an empty frame on missing columns."""
    settings = settings or ScoringSettings()
    wanted = scorer.features
    missing = [c for c in (*wanted, *settings.identifier_columns) if c not in features.columns]
    usable = features
    if missing:
        logger.warning("features lack the columns %s; nothing is scored", ", ".join(sorted(missing)))
        types = {c: "double" for c in wanted} | {c: "string" for c in settings.identifier_columns}
        usable = ensure_columns(features, types).limit(0)
    wide = ensure_columns(usable, {c: "string" for c in settings.group_by_columns})
    sizes = group_sizes(wide.select(_group_id(settings).alias("group_id")), ["group_id"])
    whole = sizes.largest <= hot_rows
    # Where whole groups fit a task, the rows are dealt out before they are scored, so that
    # scores and texts are not shuffled. The rows of a Python model are dealt out again anyway.
    early = whole and not isinstance(scorer, PandasScorer)
    usable = spread_keys(wide, [_group_id(settings)], sizes.total).select(*usable.columns) if early else usable
    scored = scorer(usable, wanted)
    groups = ensure_columns(scored, {c: "string" for c in settings.group_by_columns})
    scored = groups.withColumns(
        {
            "explosive_score": F.col("lgbm_score"),
            "reason": reason_json(F.col(CONTRIBUTIONS), settings.top_contributors),
            "dt": calendar_date("dt"),
            "group_id": _group_id(settings),
        }
    ).drop(CONTRIBUTIONS)
    if whole and not early:
        scored = spread_keys(scored, ["group_id"], sizes.total)

    def in_group(df: DataFrame) -> DataFrame:
        return rank_values(df, ["group_id"], "lgbm_score", dense="rank_in_group", hot_rows=hot_rows, sizes=sizes)

    # Later passes read the written scores; the model must run only once.
    if whole:
        ranked = materialize(in_group(scored), "scores", "zstd")
    else:
        ranked = in_group(materialize(scored, "scores", "zstd"))
    ranked = ranked.withColumn("group_rank", F.col("rank_in_group"))
    ranked = top_ranks(ranked, ["site", "category"], "lgbm_score", settings.rank_min, "rank_in_cat", dense=True)
    return ranked.withColumn("model_version", F.lit(settings.model_version))


def _group_id(settings: ScoringSettings) -> Column:
    columns = settings.group_by_columns
    return group_key([F.col(c) for c in columns], ["UNKNOWN"] * len(columns))


def request_records(requests: DataFrame, item: str = "item") -> DataFrame:
    """Typed feature records from JSON text; fields beyond the base ones go to `extra`."""
    base = F.from_json(F.col(item), RECORD_SCHEMA)
    everything = F.from_json(F.col(item), "map<string,string>")
    extra = F.map_filter(everything, lambda k, _: ~k.isin(*BASE_FIELDS))
    return (
        requests.select(base.alias("b"), extra.alias("extra"))
        .select("b.*", "extra")
        .withColumn("dt", calendar_date("dt"))
    )


def scored_items(scored: DataFrame, run_date: dt.date) -> DataFrame:
    """The typed response rows of a scored frame, with its fallbacks for missing columns."""
    rows = ensure_columns(
        scored,
        {
            "dt": "date",
            "category": "string",
            "explosive_score": "double",
            "lgbm_score": "double",
            "rank_in_cat": "bigint",
            "reason": "string",
            "group_id": "string",
        },
    )
    group_rank = next((c for c in ("rank_in_group", "group_rank") if c in scored.columns), None)
    empty = F.create_map().cast("map<string,double>")
    return rows.select(
        "asin",
        "site",
        F.coalesce(calendar_date("dt"), F.lit(run_date)).alias("dt"),
        "category",
        F.coalesce(F.col("explosive_score"), F.col("lgbm_score")).cast("double").alias("explosive_score"),
        F.coalesce(F.col("lgbm_score"), F.col("explosive_score")).cast("double").alias("lgbm_score"),
        F.col("rank_in_cat").cast("bigint").alias("rank_in_cat"),
        (F.col(group_rank) if group_rank else F.lit(None)).cast("bigint").alias("rank_in_group"),
        F.coalesce(F.from_json("reason", "map<string,double>"), empty).alias("reason"),
        "group_id",
    )


@dataclass
class BatchRun:
    """Outcome of one daily scoring job."""

    run_date: dt.date
    model_version: str
    items: DataFrame | None
    feature_snapshot_path: str | None = None
    score_artifacts: dict[str, str] = field(default_factory=dict)


def run_batch(
    spark: SparkSession,
    feature_root: str,
    score_views: Mapping[str, str],
    scorer: LinearScorer | PipelineScorer | PandasScorer,
    settings: ScoringSettings | None = None,
    as_of: dt.date | None = None,
    feature_view: tuple[str, str] | None = None,
) -> BatchRun:
    """Score the newest feature snapshot at or before `as_of` and export it.

    `score_views` maps view names to export folders; `feature_view` is an optional
    (name, folder) for the features themselves. Items are read back from the export.
    """
    settings = settings or ScoringSettings()
    features, found = load_latest(spark, feature_root, as_of)
    if features is None or found is None:
        return BatchRun(as_of or dt.date.today(), settings.model_version, None)
    if feature_view is not None:
        export_view(features, feature_view[1], feature_view[0], found)
    scored = score_batch(features, scorer, settings)
    artifacts: dict[str, str] = {}
    for name, root in score_views.items():
        # The first export is the stored result; later uses read it instead of scoring again.
        scored = export_view(scored, root, name, found)
        artifacts[name] = root
    return BatchRun(found, settings.model_version, scored_items(scored, found), feature_root, artifacts)


def store_features(features: DataFrame, feature_root: str, snapshot_date: dt.date) -> None:
    """Persist a day's feature snapshot."""
    write_snapshot(features, feature_root, snapshot_date)


def top_contributions(df: DataFrame, columns: list[str], limit: int = 5) -> DataFrame:
    """Add `reason`, the `limit` largest of the given contribution columns."""
    return df.withColumn("reason", reason_json(value_map(columns), limit))
