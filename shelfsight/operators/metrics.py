"""Ranking, classification and regression metrics as distributed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.functions.columns import null_safe_join
from shelfsight.operators.running import running_sums
from shelfsight.settings import HOT_ROWS

DEFAULT_KS = (5, 10, 20)


def _gain(relevance: Column, position: Column) -> Column:
    return (F.pow(F.lit(2.0), relevance) - 1) / F.log2(position + 1)


def _ordered(
    df: DataFrame, group: Sequence[str], score: str, label: str, tie: Sequence[str], hot_rows: int
) -> DataFrame:
    order = [F.col(score).desc_nulls_last(), *[F.col(c).asc() for c in tie]]
    hit = (F.col(label) > 0).cast("int")
    slim = df.select(*group, score, label, *[c for c in tie if c not in (*group, score, label)])
    return running_sums(slim, group, order, {"_pos": F.lit(1), "_hits": hit}, hot_rows)


def _group_quality(
    df: DataFrame, group: Sequence[str], score: str, label: str, tie: Sequence[str], ks: Sequence[int],
    prefix: str, hot_rows: int,
) -> DataFrame:
    """Per group: DCG@k, recall@k and average precision of one ordering."""
    ranked = _ordered(df, group, score, label, tie, hot_rows)
    hit, pos = F.col(label) > 0, F.col("_pos")
    relevant = F.count_if(hit)
    aggregates = [
        F.coalesce(F.sum(F.when(hit, F.col("_hits") / pos)) / F.nullif(relevant, F.lit(0)), F.lit(0.0)).alias(
            f"{prefix}ap"
        )
    ]
    for k in ks:
        found = F.count_if(hit & (pos <= k))
        aggregates.append(
            F.coalesce(F.try_divide(found, relevant), F.lit(0.0)).alias(f"{prefix}recall@{k}")
        )
        aggregates.append(
            F.sum(F.when(pos <= k, _gain(F.col(label), pos)).otherwise(0.0)).alias(f"{prefix}dcg@{k}")
        )
    return ranked.groupBy(*group).agg(*aggregates)


def _ideal(df: DataFrame, group: Sequence[str], label: str, ks: Sequence[int], hot_rows: int) -> DataFrame:
    """DCG@k of the best possible order: equal labels are counted, not sorted.

    A run of `c` equal labels ending at position `e` fills positions e-c+1..e, of
    which only those up to k count, so a run expands to at most max(ks) terms.
    """
    counted = df.groupBy(*group, label).agg(F.count(F.lit(1)).alias("_c"))
    runs = running_sums(counted, group, [F.col(label).desc()], {"_end": F.col("_c")}, hot_rows)
    start = F.col("_end") - F.col("_c") + 1
    top = runs.where(start <= max(ks)).withColumn(
        "_pos", F.explode(F.sequence(start, F.least(F.col("_end"), F.lit(max(ks)).cast("bigint"))))
    )
    gain = _gain(F.col(label), F.col("_pos"))
    return top.groupBy(*group).agg(
        *[F.sum(F.when(F.col("_pos") <= k, gain).otherwise(0.0)).alias(f"ideal@{k}") for k in ks]
    )


def _named_rows(row: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(f"`{n}`").cast("double").alias("value")) for n in names])
    return row.select(*by, F.explode(pairs).alias("m")).select(*by, "m.metric", "m.value")


def ranking_metrics(
    df: DataFrame,
    group: str,
    label: str,
    score: str,
    baseline: str | None = None,
    ks: Sequence[int] = DEFAULT_KS,
    tie: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
    by: Sequence[str] = (),
) -> DataFrame:
    """(metric, value) rows: ndcg@k, recall@k, map and, with a baseline, its lift.

    Equal scores are ordered by the `tie` columns. Values are means over groups; rows that
    differ in the `by` columns are judged apart, and these columns lead the result.
    """
    groups = [*by, group]
    per_group = null_safe_join(
        _group_quality(df, groups, score, label, tie, ks, "", hot_rows), _ideal(df, groups, label, ks, hot_rows), groups
    )
    if baseline is not None:
        per_group = null_safe_join(
            per_group, _group_quality(df, groups, baseline, label, tie, ks, "baseline_", hot_rows), groups, "inner"
        )
    means: list[Column] = []
    for k in ks:
        ndcg = F.coalesce(F.try_divide(F.col(f"`dcg@{k}`"), F.nullif(F.col(f"`ideal@{k}`"), F.lit(0.0))), F.lit(0.0))
        means += [F.avg(ndcg).alias(f"ndcg@{k}"), F.avg(f"`recall@{k}`").alias(f"recall@{k}")]
        if baseline is not None:
            lift = F.col(f"`recall@{k}`") - F.col(f"`baseline_recall@{k}`")
            means += [
                F.avg(f"`baseline_recall@{k}`").alias(f"baseline_recall@{k}"),
                F.avg(lift).alias(f"lift@{k}"),
            ]
    means.append(F.avg("ap").alias("map"))
    if baseline is not None:
        means.append(F.avg("baseline_ap").alias("baseline_map"))
    summary = per_group.groupBy(*by).agg(*means)
    return _named_rows(summary, summary.columns[len(by) :], by)


def lift_curve(
    df: DataFrame,
    group: str,
    label: str,
    score: str,
    baseline: str,
    ks: Sequence[int] = DEFAULT_KS,
    tie: Sequence[str] = (),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(k, recall, baseline_recall, lift), each the mean over groups."""
    if missing := [c for c in (group, label, score, baseline) if c not in df.columns]:
        raise ValueError(f"lift curve needs the columns {missing}")
    both = null_safe_join(
        _group_quality(df, [group], score, label, tie, ks, "", hot_rows),
        _group_quality(df, [group], baseline, label, tie, ks, "baseline_", hot_rows),
        [group],
        "inner",
    )
    points = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(k).alias("k"),
                    F.col(f"`recall@{k}`").alias("recall"),
                    F.col(f"`baseline_recall@{k}`").alias("baseline_recall"),
                )
                for k in ks
            ]
        )
    )
    return (
        both.select(points.alias("p"))
        .groupBy(F.col("p.k").alias("k"))
        .agg(
            F.avg("p.recall").alias("recall"),
            F.avg("p.baseline_recall").alias("baseline_recall"),
            F.avg(F.col("p.recall") - F.col("p.baseline_recall")).alias("lift"),
        )
    )


def _clipped(probability: str) -> Column:
    p = F.col(probability).cast("double")
    return F.greatest(F.least(p, F.lit(1 - 1e-15)), F.lit(1e-15))


def roc_auc(df: DataFrame, label: str, score: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row `roc_auc`: share of (positive, negative) pairs in order, ties half.

    Rows reduce to one counted row per distinct score before they are ordered.
    """
    counted = df.groupBy(F.col(score).alias("s")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    below = running_sums(counted, [], [F.col("s").asc()], {"upto": F.col("neg")}, hot_rows)
    wins = F.col("pos") * (F.col("upto") - F.col("neg") + F.col("neg") / 2)
    totals = below.agg(F.sum(wins).alias("w"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    pairs = F.col("p").cast("double") * F.col("n")
    return totals.select(F.try_divide("w", F.nullif(pairs, F.lit(0.0))).alias("roc_auc"))


def binary_metrics(
    df: DataFrame, label: str, probability: str, threshold: float = 0.5, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(metric, value) rows of the confusion-based metrics, AUC and log-loss."""
    rows = df.select(F.col(label).alias("y"), _clipped(probability).alias("p"))
    positive = F.col("p") >= threshold
    counts = rows.agg(
        F.count_if((F.col("y") == 1) & positive).alias("tp"),
        F.count_if((F.col("y") == 0) & ~positive).alias("tn"),
        F.count_if((F.col("y") == 0) & positive).alias("fp"),
        F.count_if((F.col("y") == 1) & ~positive).alias("fn"),
        (-F.avg(F.col("y") * F.ln("p") + (1 - F.col("y")) * F.ln(1 - F.col("p")))).alias("log_loss"),
    )
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("tp", "tn", "fp", "fn"))

    def ratio(a: Column, b: Column) -> Column:
        return F.try_divide(a, F.nullif(b, F.lit(0.0)))

    derived = counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "specificity": ratio(tn, tn + fp),
        }
    )
    defined = (F.col("precision") > 0) & (F.col("recall") > 0)
    derived = derived.withColumns(
        {
            "f1": F.when(
                defined,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
            ),
            "balanced_accuracy": (F.col("recall") + F.col("specificity")) / 2,
        }
    )
    full = derived.withColumn("roc_auc", roc_auc(rows, "y", "p", hot_rows).scalar())
    names = ("accuracy", "precision", "recall", "f1", "balanced_accuracy", "roc_auc", "log_loss")
    return _named_rows(full, names)


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """(metric, value) rows: rmse, mae, mse and r2 (missing without variance)."""
    error = F.col(label) - F.col(prediction)
    sums = df.agg(
        F.avg(error * error).alias("mse"), F.avg(F.abs(error)).alias("mae"), F.var_pop(label).alias("v")
    )
    full = sums.withColumns(
        {
            "rmse": F.sqrt("mse"),
            "r2": 1 - F.try_divide(F.col("mse"), F.nullif(F.col("v"), F.lit(0.0))),
        }
    )
    return _named_rows(full, ("rmse", "mae", "mse", "r2"))
