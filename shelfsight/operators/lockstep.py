"""Boosted regressions with many settings on several folds, all grown side by side.

A fit by Spark ML is a chain of short jobs, one or more per tree level, and a search runs a
hundred fits and more. Here the rows of a fold are binned once and written. A fold of up to
TASK_ROWS rows is small enough for one task, so each fit of it is one task and all fits are
one job. Rows of larger folds stay spread: all fits take their next level in one job, in
which every task adds up the label sums per bin of its rows, and the driver picks the
splits. What a task sends does not depend on its rows.

Either way the trees are those of `GBTRegressor` with the same settings and seed: Spark ML
finds the bin borders, rows are drawn by its generator, and gains are summed in its order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache, reduce
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.settings import TASK_ROWS
from shelfsight.sources.scratch import materialize

#: Settings of GBTRegressor that may be given once for all fits, and those that may differ from fit to fit.
TOGETHER = frozenset({"maxIter", "stepSize", "maxDepth", "minInstancesPerNode", "subsamplingRate", "minInfoGain", "maxBins"})
EACH = TOGETHER - {"maxIter", "maxBins"}
#: Bytes of sums per fold that a task holds and sends in one job; a level with more nodes takes several jobs.
SUM_BYTES = 32 << 20
#: Results of so many tasks go to the driver at once; more are added up on the way.
FAN_IN = 32
#: Spark ML takes a smaller impurity as none.
EPSILON = 2.0**-52


class Setting(NamedTuple):
    """What a fit needs to know of its GBTRegressor."""

    rounds: int
    step: float
    depth: int
    least: int
    rate: float
    gain: float


class Tree(NamedTuple):
    """Nodes in arrays: feature (-1 for a leaf), the last bin that goes left, the left child (the right one follows), value."""

    feature: np.ndarray
    last: np.ndarray
    left: np.ndarray
    value: np.ndarray

    def nodes(self, x: np.ndarray, rows: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The node that each of the `rows` of `x` (features by rows) reaches, from the root or on from the node `at`."""
        at = np.zeros(len(rows), np.int64) if at is None else at
        inner = self.feature >= 0
        while (going := inner[at]).any():
            feature = self.feature[at]
            at = np.where(going, self.left[at] + (x[feature, rows] > self.last[at]), at)
        return at


class Block(NamedTuple):
    """Training rows of one slice: bins (features by rows), labels, and the predictions so far of each fit of the fold."""

    fold: int
    part: int
    x: np.ndarray
    y: np.ndarray
    scores: dict[int, np.ndarray]


class Fold(NamedTuple):
    """A fold's training rows as a table of blocks, their number, each feature's bin borders, and the generators' first states."""

    blocks: DataFrame
    rows: int
    borders: list[np.ndarray]
    states: list[int]


Key = tuple[int, int]  # fold and fit


def supports(options: Iterable[str], space: Iterable[str]) -> bool:
    """Whether fits with these `options` that differ in the settings of `space` can be grown side by side."""
    return TOGETHER.issuperset(options) and EACH.issuperset(space)


def setting(learner: GBTRegressor) -> Setting:
    """The learner's values, checked by Spark ML."""
    learner._transfer_params_to_java()
    return Setting(
        learner.getMaxIter(), learner.getStepSize(), learner.getMaxDepth(), learner.getMinInstancesPerNode(),
        learner.getSubsamplingRate(), learner.getMinInfoGain(),
    )


def _singleton(jvm: Any, name: str) -> Any:
    return getattr(getattr(jvm, name + "$"), "MODULE$")


def _borders(rows: DataFrame, learner: GBTRegressor) -> list[np.ndarray]:
    """The bin borders that Spark ML finds on `rows`; it also refuses labels that are missing."""
    jvm = rows.sparkSession.sparkContext._jvm
    learner._transfer_params_to_java()
    java = learner._java_obj
    data = _singleton(jvm, "org.apache.spark.ml.util.DatasetUtils")
    instances = data.extractInstances(java, rows._jdf, getattr(data, "extractInstances$default$3")())
    algo = _singleton(jvm, "org.apache.spark.mllib.tree.configuration.Algo").Regression()
    none = _singleton(jvm, "scala.collection.immutable.Map").empty()
    strategy = java.getOldBoostingStrategy(none, algo).treeStrategy()
    metadata = jvm.org.apache.spark.ml.tree.impl.DecisionTreeMetadata.buildMetadata(instances, strategy, 1, "all")
    splits = _singleton(jvm, "org.apache.spark.ml.tree.impl.RandomForest").findSplits(instances, metadata, learner.getSeed())
    return [np.array([s.threshold() for s in found], np.float64) for found in splits]


def _bins(x: np.ndarray, borders: list[np.ndarray]) -> np.ndarray:
    """Features by rows: a value is in the first bin whose border is not below it."""
    kind = np.uint8 if max(map(len, borders)) < 256 else np.int32
    return np.array([np.searchsorted(b, column, "left") for b, column in zip(borders, x.T)], kind).reshape(len(borders), len(x))


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def prepare(rows: DataFrame, learner: GBTRegressor) -> Fold:
    """A fold's training `rows`, binned, in the slices that Spark ML would read. Starts Spark jobs."""
    borders = _borders(rows, learner)
    width = len(borders)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys = [_bins(np.zeros((0, width)), borders)], [np.zeros(0)]
        for batch in batches:
            xs.append(_bins(_matrix(batch["x"], width), borders))
            ys.append(batch["y"].to_numpy(zero_copy_only=False))
        x, y = np.concatenate(xs, 1), np.concatenate(ys)
        block = {"part": TaskContext.get().partitionId(), "n": len(y), "wide": x.itemsize, "x": x.tobytes(), "y": y.tobytes()}
        yield pa.RecordBatch.from_pylist([block], pa.schema([("part", pa.int32()), ("n", pa.int64()), ("wide", pa.int32()), ("x", pa.binary()), ("y", pa.binary())]))

    slim = rows.select(vector_to_array(learner.getFeaturesCol()).alias("x"), F.col(learner.getLabelCol()).cast("double").alias("y"))
    blocks = materialize(slim.mapInArrow(cut, "part int, n long, wide int, x binary, y binary"), "blocks")
    found = blocks.agg(F.sum("n").alias("rows"), F.max("part").alias("last")).first()
    hashed = _singleton(rows.sparkSession.sparkContext._jvm, "org.apache.spark.util.random.XORShiftRandom").hashSeed
    parts, rounds = found["last"] + 1, learner.getMaxIter()
    # Spark ML seeds the generator of a round and a slice with the sum of their numbers.
    states = [hashed(learner.getSeed() + k + 1) % (1 << 64) for k in range(rounds + parts)]
    return Fold(blocks, found["rows"], borders, states)


# --- Spark's generator -------------------------------------------------------


def _next(state: np.ndarray) -> np.ndarray:
    state = state ^ (state << np.uint64(21))
    state = state ^ (state >> np.uint64(35))
    return state ^ (state << np.uint64(4))


def _tables(images: np.ndarray) -> np.ndarray:
    """Eight tables of 256 entries for a linear map of 64 bits, given the images of the single bits."""
    tables = np.zeros((8, 256), np.uint64)
    for byte in range(8):
        for bit in range(8):
            tables[byte, 1 << bit : 2 << bit] = tables[byte, : 1 << bit] ^ images[8 * byte + bit]
    return tables


def _mapped(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    out = tables[0][state & np.uint64(255)]
    for byte in range(1, 8):
        out ^= tables[byte][(state >> np.uint64(8 * byte)) & np.uint64(255)]
    return out


@lru_cache(maxsize=64)  # one entry per bit of the number of rows at most
def _jump(doublings: int) -> np.ndarray:
    """The map of 2^doublings steps: every step is linear in the state's bits."""
    if not doublings:
        return _tables(_next(np.uint64(1) << np.arange(64, dtype=np.uint64)))
    half = _jump(doublings - 1)
    return _tables(_mapped(half, _mapped(half, np.uint64(1) << np.arange(64, dtype=np.uint64))))


def draws(start: int, n: int) -> np.ndarray:
    """The first `n` values of nextDouble of an XORShiftRandom whose state is `start`; each takes two steps."""
    states, k = _next(np.array([start], np.uint64)), 0
    while len(states) < 2 * n:
        states, k = np.concatenate([states, _mapped(_jump(k), states)]), k + 1
    high, low = states[: 2 * n : 2] & np.uint64((1 << 26) - 1), states[1 : 2 * n : 2] & np.uint64((1 << 27) - 1)
    return ((high << np.uint64(27)) + low).astype(np.float64) * 2.0**-53


# --- on the tasks ------------------------------------------------------------


class Level(NamedTuple):
    """The nodes of one fit whose sums are wanted: its tree so far and each node's slot (-1 for none)."""

    tree: Tree
    slots: np.ndarray
    width: int


def _block(fold: int, width: int, row: Any) -> Block:
    x = np.frombuffer(row["x"], np.uint8 if row["wide"] == 1 else np.int32).reshape(width, -1)
    return Block(fold, row["part"], x, np.frombuffer(row["y"], np.float64), {})


def _drawn(block: Block, s: Setting, start: int) -> np.ndarray:
    """The rows of a block that a round draws."""
    return np.flatnonzero(draws(start, len(block.y)) < s.rate) if s.rate < 1 else np.arange(len(block.y))


def _sums(
    block: Block, levels: dict[Key, Level], fits: dict[Key, Setting], number: int, start: int, bins: int, reached: dict | None = None
) -> dict[Key, np.ndarray]:
    """For each fit of the block's fold: rows, label sums and sums of squares, by slot, feature and bin.

    `reached`, if given, keeps a round's drawn rows and their nodes from level to level.
    """
    out = {}
    for key, level in levels.items():
        if key[0] != block.fold:
            continue
        known = reached and reached.get((key, block.part))
        rows, at = known or (_drawn(block, fits[key], start), None)
        at = level.tree.nodes(block.x, rows, at)
        if reached is not None:
            reached[key, block.part] = rows, at
        slot = level.slots[at]
        rows, slot = rows[slot >= 0], slot[slot >= 0] * bins
        y = block.y[rows]
        if number:  # what the trees so far leave, as Spark ML's squared error has it
            y = 2.0 * (y - block.scores[key[1]][rows])
        square, size = y * y, level.width * bins
        out[key] = np.empty((3, level.width, len(block.x), bins))
        for feature, x in enumerate(block.x):
            at = slot + x[rows]
            for k, weights in enumerate((None, y, square)):
                out[key][k, :, feature] = np.bincount(at, weights, size).reshape(level.width, bins)
    return out


def _added(one: dict[Key, np.ndarray], other: dict[Key, np.ndarray]) -> dict[Key, np.ndarray]:
    return one | {key: one[key] + found if key in one else found for key, found in other.items()}


def _moved(block: Block, trees: dict[Key, Tree], fits: dict[Key, Setting], number: int) -> Block:
    """The block with the scores after the trees of round `number`; the first tree counts in full."""
    rows, scores = np.arange(len(block.y)), {}
    for (fold, fit), tree in trees.items():
        if fold == block.fold:
            added = tree.value[tree.nodes(block.x, rows)] * (fits[fold, fit].step if number else 1.0)
            scores[fit] = block.scores[fit] + added if number else added
    return block._replace(scores=scores)


# --- growth ------------------------------------------------------------------


def _impurity(sums: np.ndarray) -> np.ndarray:
    """Variance from (rows, sum, sum of squares) on the last axis; 0 without rows."""
    n = np.where(sums[..., 0] == 0, 1.0, sums[..., 0])
    return np.where(sums[..., 0] == 0, 0.0, (sums[..., 2] - sums[..., 1] * sums[..., 1] / n) / n)


class _Growing:
    """A tree that is being grown, level by level."""

    def __init__(self, s: Setting, cuts: Sequence[int]):
        self.s, self.cuts = s, cuts
        self.feature, self.last, self.left = [-1], [0], [0]
        self.sums: list[np.ndarray | None] = [None]
        self.level, self.open = 0, [0]

    def tree(self) -> Tree:
        value = [0.0 if s is None or not s[0] else s[1] / s[0] for s in self.sums]
        return Tree(np.array(self.feature), np.array(self.last), np.array(self.left), np.array(value))

    def split(self, found: np.ndarray) -> None:
        """Split the open nodes by their sums (kind, slot, feature, bin); of equal gains the first feature and border wins."""
        upto = np.moveaxis(np.cumsum(found, axis=-1), 0, -1)
        total = upto[:, :, -1:]
        below = upto[:, :, :-1]
        above = total - below
        tried = np.arange(below.shape[2])[None, :] < np.array(self.cuts)[:, None]
        if not self.level:  # the root's sums are those of the two sides of the first split
            first = next((f for f, n in enumerate(self.cuts) if n), None)
            self.sums[0] = total[0, 0, 0] if first is None else below[0, first, 0] + above[0, first, 0]
        mine = _impurity(np.array([self.sums[n] for n in self.open]))[:, None, None]
        rows = below[..., 0] + above[..., 0]
        rows = np.where(rows == 0, 1.0, rows)
        gain = mine - below[..., 0] / rows * _impurity(below) - above[..., 0] / rows * _impurity(above)
        few = (below[..., 0] < self.s.least) | (above[..., 0] < self.s.least)
        gain = np.where(few | (gain < self.s.gain) | ~tried, -np.inf, gain).reshape(len(self.open), -1)
        opened, last_level = [], self.level + 1 >= self.s.depth
        for slot, node in enumerate(self.open):
            best = int(gain[slot].argmax()) if gain.shape[1] else 0
            if self.level >= self.s.depth or not gain.shape[1] or not gain[slot, best] > 0:
                continue
            feature, cut = divmod(best, below.shape[2])
            self.feature[node], self.last[node], self.left[node] = feature, cut, len(self.sums)
            for side in (below, above):
                sums = side[slot, feature, cut]
                if not last_level and abs(_impurity(sums)) >= EPSILON:
                    opened.append(len(self.sums))
                self.sums.append(sums)
                self.feature.append(-1)
                self.last.append(0)
                self.left.append(0)
        self.level, self.open = self.level + 1, opened


def _portions(growing: dict[Key, _Growing], most: int) -> Iterator[dict[Key, Level]]:
    """The open nodes of each fit, at most `most` of a fold at a time."""
    waiting = {key: g.open for key, g in growing.items() if g.open}
    trees = {key: growing[key].tree() for key in waiting}
    while waiting:
        out, room = {}, dict.fromkeys({fold for fold, _ in waiting}, most)
        for key, nodes in waiting.items():
            if taken := nodes[: room[key[0]]]:
                slots = np.full(len(trees[key].feature), -1)
                slots[taken] = np.arange(len(taken))
                out[key] = Level(trees[key], slots, len(taken))
                room[key[0]] -= len(taken)
        waiting = {key: left for key, nodes in waiting.items() if (left := nodes[out[key].width if key in out else 0 :])}
        yield out


def _boost(
    fits: dict[Key, Setting], cuts: list[list[int]], most: int,
    sums: Callable[[dict[Key, Level], int], dict[Key, np.ndarray]], move: Callable[[dict[Key, Tree], int], None],
) -> dict[Key, list[Tree]]:
    """The trees of each fit. `sums` adds up all rows of a level, `move` adds the trees of a round to the scores."""
    found: dict[Key, list[Tree]] = {key: [] for key in fits}
    for number in range(max(s.rounds for s in fits.values())):
        growing = {key: _Growing(s, cuts[key[0]]) for key, s in fits.items() if number < s.rounds}
        if number:
            move({key: found[key][-1] for key in growing}, number - 1)
        while any(g.open for g in growing.values()):
            parts: dict[Key, list[np.ndarray]] = {}
            for levels in _portions(growing, most):
                for key, added in sums(levels, number).items():
                    parts.setdefault(key, []).append(added)
            for key, added in parts.items():
                growing[key].split(np.concatenate(added, 1))
        for key, g in growing.items():
            found[key].append(g.tree())
    return found


class _Spread:
    """Rows that stay spread over tasks: a job per level for all fits."""

    def __init__(self, blocks: RDD, fits: dict[Key, Setting], states: list[list[int]], bins: int):
        self.rows, self.fits, self.states, self.bins = blocks, fits, states, bins
        self.depth = max(1, math.ceil(math.log(max(blocks.getNumPartitions(), 2), FAN_IN)))
        self.held: list[RDD] = []

    def sums(self, levels: dict[Key, Level], number: int) -> dict[Key, np.ndarray]:
        fits, states, bins = self.fits, self.states, self.bins

        def summed(blocks: Iterable[Block]) -> Iterator[dict]:
            yield reduce(_added, (_sums(b, levels, fits, number, states[b.fold][number + b.part], bins) for b in blocks), {})

        return self.rows.mapPartitions(summed).treeReduce(_added, self.depth)

    def move(self, trees: dict[Key, Tree], number: int) -> None:
        fits = self.fits
        self.rows = self.rows.map(lambda block: _moved(block, trees, fits, number)).persist(StorageLevel.MEMORY_AND_DISK)
        self.held.append(self.rows)
        if len(self.held) > 2:
            self.held.pop(0).unpersist()

    def release(self) -> None:
        for rdd in self.held:
            rdd.unpersist()


class _Here:
    """All rows of a fold in the memory of one task."""

    def __init__(self, blocks: list[Block], fits: dict[Key, Setting], states: list[list[int]], bins: int):
        self.blocks, self.fits, self.states, self.bins = sorted(blocks, key=lambda b: b.part), fits, states, bins
        self.reached: dict = {}

    def sums(self, levels: dict[Key, Level], number: int) -> dict[Key, np.ndarray]:
        found = (_sums(b, levels, self.fits, number, self.states[b.fold][number + b.part], self.bins, self.reached) for b in self.blocks)
        return reduce(_added, found, {})

    def move(self, trees: dict[Key, Tree], number: int) -> None:
        self.blocks, self.reached = [_moved(b, trees, self.fits, number) for b in self.blocks], {}


def fit(folds: Sequence[Fold], settings: Sequence[Setting], task_rows: int = TASK_ROWS) -> list[list[list[Tree]]]:
    """The trees by setting and fold: one job, or one per level where a fold has more than `task_rows` rows."""
    context = folds[0].blocks.sparkSession.sparkContext
    width = len(folds[0].borders)
    bins = max(len(b) for fold in folds for b in fold.borders) + 1
    most = max(1, SUM_BYTES // (24 * bins * width))
    cuts, states = [[len(b) for b in fold.borders] for fold in folds], [fold.states for fold in folds]
    fits = {(f, k): s for f in range(len(folds)) for k, s in enumerate(settings)}
    if max(fold.rows for fold in folds) <= task_rows:
        keys = list(fits)

        def grown(task: int, rows: Iterable[Any]) -> Iterator[Any]:
            key = keys[task]
            here = _Here([_block(key[0], width, row) for row in rows], {key: fits[key]}, states, bins)
            yield key, _boost({key: fits[key]}, cuts, most, here.sums, here.move)[key]

        whole = [fold.blocks.rdd.coalesce(1) for fold in folds]
        found = dict(context.union([whole[f] for f, _ in keys]).mapPartitionsWithIndex(grown).collect())
    else:

        def read(f: int) -> RDD:
            return folds[f].blocks.rdd.map(lambda row: _block(f, width, row))

        spread = _Spread(context.union([read(f) for f in range(len(folds))]), fits, states, bins)
        found = _boost(fits, cuts, most, spread.sums, spread.move)
        spread.release()
    return [[found[f, k] for f in range(len(folds))] for k in range(len(settings))]


def score(rows: DataFrame, features: str, borders: list[np.ndarray], settings: Sequence[Setting], fits: Sequence[Sequence[Tree]]) -> DataFrame:
    """Each of the `rows` once per fit, with `_fit` and `prediction`, the sum of the fit's trees; without `features`."""
    kept = [c for c in rows.columns if c != features]
    width = len(borders)

    def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, every = _bins(_matrix(batch[features], width), borders), np.arange(batch.num_rows)
            for k, (s, trees) in enumerate(zip(settings, fits)):
                total = np.zeros(batch.num_rows)
                for number, tree in enumerate(trees):
                    total = total + tree.value[tree.nodes(x, every)] * (s.step if number else 1.0)
                own = [pa.array(np.full(batch.num_rows, k, np.int32)), pa.array(total)]
                yield pa.RecordBatch.from_arrays([*(batch[c] for c in kept), *own], [*kept, "_fit", "prediction"])

    schema = rows.select(*kept, F.lit(0).alias("_fit"), F.lit(0.0).alias("prediction")).schema
    return rows.withColumn(features, vector_to_array(features)).mapInArrow(added, schema)
