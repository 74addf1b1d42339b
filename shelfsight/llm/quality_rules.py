"""Quality rules whose cutoffs are proven on labelled holdouts.

Each rule rejects a text when a rate is above a cutoff. Per stratum the rules are
tightened along one path of cutoff vectors, each stricter than the one before in one
rule. The path is laid by rows outside the holdout: the cutoffs above which most rows
are labelled bad come first, and those above which bad texts are not expected to be the
most are left out. The vectors are then tested in that order on the labelled
good texts of the stratum: one passes when, were its false rejection rate above the
allowed one, so few rejections by any rule would have a probability below the allowed
error (an exact binomial test, the Clopper-Pearson bound). Testing stops at the first
failure, so the order needs no correction and the rules share no allowance. Strata
share the error by Holm's method: what a stratum whose whole path has passed was given
goes to the others. With probability 1 - ERROR, at most FALSE_REJECTION of the good
texts are rejected in every stratum.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfsight.llm import arrays
from shelfsight.llm.common import binomial_tail
from shelfsight.sources.scratch import materialize

SYMBOLS = np.zeros(256, dtype=bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
UPPER = np.zeros(256, dtype=bool)
UPPER[65:91] = True
WINDOW = 8
#: From strict to lenient; the last never rejects.
CUTOFFS = (0.0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.12, 0.2, 0.3, 0.45, 0.7, 1.0)
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_stutters", "n_marked")


@dataclass(frozen=True)
class Risk:
    """Allowed share of good texts rejected per stratum, the probability of exceeding it, and
    the share of bad texts that is to be expected above a cutoff for it to be tried."""

    false_rejection: float = 0.05
    error: float = 0.05
    least_bad: float = 0.5
    cutoffs: tuple[float, ...] = CUTOFFS


def _rate(part: str, whole: str) -> Callable[..., Column]:
    """The rate as a column, its inputs named with a prefix."""
    return lambda prefix="": F.coalesce(F.try_divide(F.col(prefix + part), F.col(prefix + whole)), F.lit(0.0))


RULES = {
    "symbols": _rate("n_symbols", "word_chars"),
    "dup_lines": _rate("n_dup_lines", "n_lines"),
    "repeats": _rate("n_repeat_words", "n_words"),
    "shouting": _rate("n_upper", "word_chars"),
    "stutters": _rate("n_stutters", "n_words"),
    "marked": _rate("n_marked", "n_words"),
}


def _per_row(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The signals of each text, given the bytes of all."""
    n = len(offsets) - 1
    starts, ends, rows = arrays.word_spans(data, offsets)
    words = arrays.firsts(rows, n)
    inside = ~arrays.SPACE[data]
    out = {
        "n_words": np.diff(words),
        "word_chars": _per_row(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_row(SYMBOLS[data], offsets),
        "n_upper": _per_row(UPPER[data], offsets),
    }
    # A word made of symbols, or ending in one: list bars, shouted marks.
    last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    out["n_marked"] = _per_row(SYMBOLS[last] | (last == ord("!")), words)

    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    breaks = np.flatnonzero(data == 10)
    heads = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
    line_row = np.searchsorted(offsets, heads, side="right") - 1
    # An empty text's head, or one that a last newline pushes past its text, has no words.
    tails = np.sort(np.concatenate([offsets[1:], breaks]))
    full = np.searchsorted(starts, tails) > np.searchsorted(starts, heads)
    heads, tails, line_row = heads[full], tails[full], line_row[full]
    keys = arrays.span_hashes(data, heads, tails)
    order = np.lexsort((keys, line_row))
    again = np.zeros(len(keys), dtype=bool)
    if len(keys) > 1:
        again[order[1:]] = (keys[order][1:] == keys[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    bounds = arrays.firsts(line_row, n)
    out["n_lines"], out["n_dup_lines"] = np.diff(bounds), _per_row(again, bounds)

    hashes = arrays.span_hashes(data, starts, ends)
    stutter = np.zeros(len(hashes), dtype=bool)
    stutter[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
    out["n_stutters"] = _per_row(stutter, words)
    grams, first = arrays.gram_hashes(hashes, rows, WINDOW)
    found = first[arrays.repeated(grams, rows[first])] if len(first) else first
    covered = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(covered, found, 1)
    np.add.at(covered, found + WINDOW, -1)
    out["n_repeat_words"] = _per_row(np.cumsum(covered)[:-1] > 0, words)
    return out


def with_signals(docs: DataFrame, text_column: str, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns `keep` of every row, its signals and whether it fails the base rule."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.slices(batch, text_column):
                found = measure(*arrays.buffers(piece.column(text_column)))
                columns = [piece.column(c) for c in keep] + [pa.array(found[s].astype(np.int64)) for s in SIGNALS]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *[prefix + s for s in SIGNALS]])

    schema = T.StructType(docs.select(*keep).schema.fields)
    for s in SIGNALS:
        schema = schema.add(prefix + s, T.LongType())
    words, again = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    failed = (words < 20) | (100 * again > 30 * words)
    return docs.mapInArrow(add, schema).withColumn(f"{prefix}base_failed", failed)


def stratum_of(column: str) -> Column:
    """The stratum's name; null gets one that no value has."""
    return F.when(F.col(column).isNull(), "null").otherwise(F.concat(F.lit("="), F.col(column)))


def lay_path(tallies: pd.DataFrame, cutoffs: int, least_bad: float) -> list[list[int]]:
    """Per rule and level, the number of the step from which on a text of that level is rejected.

    `tallies` has a row per rule and level of the rows outside the holdout: how many have
    a rate above exactly `level` of the cutoffs, how many of them are labelled bad, and
    the rows of the holdout, of which only the sum is used. Level 0 is never rejected. A
    rule is tightened while, at the share of rows that are labelled at all, `least_bad`
    of the rows above the cutoff are expected to be bad.
    """
    rule, level = tallies["rule"].to_numpy(), tallies["level"].to_numpy()
    rows, bad = np.zeros((2, len(RULES), cutoffs + 1))
    np.add.at(rows, (rule, level), tallies["n"].to_numpy())
    np.add.at(bad, (rule, level), tallies["n_bad"].to_numpy())
    good = float(tallies["n_good"].to_numpy()[rule == 0].sum())
    labelled = (bad[0].sum() + good) / max(1.0, rows[0].sum() + good)
    above = lambda x: np.cumsum(x[:, ::-1], axis=1)[:, ::-1]
    rows, bad = above(rows), above(bad)
    order = []
    for k in range(len(RULES)):
        worst = 1.0
        for at in range(cutoffs, 0, -1):
            if bad[k, at] * (1 - labelled) < least_bad * labelled * (rows[k, at] - bad[k, at]):
                break
            worst = min(worst, (bad[k, at] + 1) / (rows[k, at] + 1))
            order.append((-worst, -at, k))
    steps = [[cutoffs * len(RULES)] * (cutoffs + 1) for _ in RULES]
    for number, (_, at, k) in enumerate(sorted(order)):
        steps[k][-at] = number
    return steps


def proven_steps(rejected: np.ndarray, rate: float, error: float) -> int:
    """How many steps of a path pass; `rejected` counts good texts by the step that rejects them, last by none."""
    total, so_far = int(rejected.sum()), np.cumsum(rejected)
    for step in range(len(rejected) - 1):
        if binomial_tail(int(so_far[step]), total, rate) > error:
            return step
    return len(rejected) - 1


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    risk: Risk = Risk(),
    id_column: str = "doc_id",
    text_column: str = "text",
    stratum_column: str = "lang",
) -> DataFrame:
    """Signals, base_failed and kept for every row of `docs`.

    `labels` has doc_id and quality (1 good, 0 bad); an id labelled twice is good
    only if always labelled so, null labels and null ids are ignored. The holdout is
    every labelled good text that passes the base rule, an id once. A null text has no
    words and so fails the base rule; a null stratum is one of its own. A stratum with
    too few good labels to prove any cutoff, or without bad ones to lay a path, rejects
    nothing beyond the base rule. Repeated rows get equal verdicts. An empty table gives no rows. Other columns
    are not read. Starts Spark jobs.
    """
    signals = measured(docs, id_column, text_column, stratum_column)
    return judged(signals, proven_cutoffs(signals, labels, risk)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules"
    )


def measured(docs: DataFrame, id_column: str, text_column: str, stratum_column: str) -> DataFrame:
    """The written signals of every row."""
    chosen = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), stratum_of(stratum_column).alias("stratum"), F.col(text_column).alias("text")
    )
    return materialize(with_signals(chosen, "text", ["doc_id", "stratum"]), "signals")


def proven_cutoffs(signals: DataFrame, labels: DataFrame, risk: Risk) -> DataFrame:
    """One row per stratum with the cutoff of each rule, null where none is proven."""
    quality = (
        labels.filter("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("quality"))
    )
    level = lambda rate: F.size(F.filter(F.array(*map(F.lit, risk.cutoffs)), lambda c: rate > c))
    rated = signals.filter(~F.col("base_failed")).select("doc_id", "stratum", F.array(*[level(f()) for f in RULES.values()]).alias("levels"))
    labelled = materialize(rated.join(quality, "doc_id"), "labelled")

    def tally(rows: DataFrame, **counted: Column) -> DataFrame:
        chosen = rows.select("stratum", F.posexplode("levels").alias("rule", "level"), *[c.alias(n) for n, c in counted.items()])
        return chosen.groupBy("stratum", "rule", "level").agg(*[F.sum(n).alias(n) for n in counted])

    # Rows outside the holdout: all but those of ids labelled good.
    bad = (F.col("quality") != 1).cast("long")
    tallies = tally(rated, n=F.lit(1), n_bad=F.lit(0), n_good=F.lit(0)).unionByName(
        tally(labelled, n=bad - 1, n_bad=bad, n_good=1 - bad)
    )
    places = len(risk.cutoffs) * len(RULES)

    def lay(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"stratum": group["stratum"].iloc[:1], "steps": [lay_path(group, len(risk.cutoffs), risk.least_bad)]})

    paths = materialize(tallies.groupBy("stratum").applyInPandas(lay, "stratum string, steps array<array<int>>"), "paths")
    earliest = F.array_min(F.transform("levels", lambda x, rule: F.get(F.get("steps", rule), x))).alias("step")
    holdout = (
        labelled.filter("quality = 1").dropDuplicates(["doc_id"]).join(paths, "stratum")
        .select("stratum", earliest).groupBy("stratum", "step").agg(F.count(F.lit(1)).alias("n"))
    )
    counts = materialize(holdout.join(paths, "stratum"), "holdout")

    def prove(tests: int) -> DataFrame:
        def per_stratum(group: pd.DataFrame) -> pd.DataFrame:
            rejected = np.zeros(places + 1, dtype=np.int64)
            np.add.at(rejected, group["step"].to_numpy(), group["n"].to_numpy())
            passed, found = proven_steps(rejected, risk.false_rejection, risk.error / tests), []
            for steps in group["steps"].iloc[0]:
                strict = [c for c, step in zip(risk.cutoffs, list(steps)[1:]) if step < passed]
                found.append(min(strict) if strict else None)
            names = ["stratum", "whole", *[f"cut_{r}" for r in RULES]]
            return pd.DataFrame([[group["stratum"].iloc[0], passed == places, *found]], columns=names)

        cuts = ", ".join(f"cut_{r} double" for r in RULES)
        return materialize(counts.groupBy("stratum").applyInPandas(per_stratum, f"stratum string, whole boolean, {cuts}"), "cutoffs")

    # Holm: a larger share of the error never takes a step back, so the count of whole paths only grows.
    strata, whole = counts.select("stratum").distinct().count(), 0
    while True:
        proven = prove(max(1, strata - whole))
        now = proven.filter("whole").count()
        if now == whole or now == strata:
            return proven.drop("whole")
        whole = now


def judged(signals: DataFrame, cutoffs: DataFrame, prefix: str = "") -> DataFrame:
    """Add kept and failed_rules to rows with signals and a stratum."""
    over = [F.coalesce(f(prefix) > F.col(f"cut_{r}"), F.lit(False)) for r, f in RULES.items()]
    failed = F.array_compact(F.array(*[F.when(o, F.lit(r)) for o, r in zip(over, RULES)]))
    stratum = F.col(f"{prefix}stratum") == F.col("_of")
    return (
        signals.join(cutoffs.withColumnRenamed("stratum", "_of"), stratum, "left")
        .withColumn(f"{prefix}failed_rules", failed)
        .withColumn(f"{prefix}kept", ~F.col(f"{prefix}base_failed") & (F.size(f"{prefix}failed_rules") == 0))
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, risk: Risk = Risk(), id_column: str = "doc_id", text_column: str = "text", stratum_column: str = "lang"
) -> DataFrame:
    """The rows of `docs` that the rules keep, with all their columns.

    Repeated rows stay or go together; an empty table stays empty. A verdict follows from the row and a row of cutoffs, so texts are not shuffled.
    """
    cutoffs = proven_cutoffs(measured(docs, id_column, text_column, stratum_column), labels, risk)
    own = docs.withColumn("_q_stratum", stratum_of(stratum_column))
    return judged(with_signals(own, text_column, own.columns, "_q_"), cutoffs, "_q_").filter("_q_kept").select(*docs.columns)
