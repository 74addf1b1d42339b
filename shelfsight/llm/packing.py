"""Best-fit packing by exact-complement hashing.

The packing is decided on the histogram of piece lengths, at most `capacity`
counts, so its size does not depend on the corpus. Single, pair and triple sums of
the available lengths are indexed; combinations that fill a gap exactly are taken
as often as their counts allow; what remains is packed best-fit, longest first.
Pieces then find their places by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.arrays import slices
from shelfsight.llm.encode import SLICE_BYTES, encoder
from shelfsight.llm.ranks import add_before, bucket_of
from shelfsight.sources.scratch import materialize

CAPACITY = 2048
Pattern = tuple[tuple[int, ...], int]


class SumIndex:
    """Which sums of one, two or three available lengths exist; kept until a length runs out."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.pairs: np.ndarray | None = None

    def take(self, lengths: tuple[int, ...]) -> int:
        """Use up a combination as often as it is there."""
        need = Counter(lengths)
        times = min(int(self.counts[n]) // k for n, k in need.items())
        if times:
            for n, k in need.items():
                self.counts[n] -= times * k
                if self.counts[n] < 2:
                    self.pairs = None
        return times

    def pair_sums(self) -> np.ndarray:
        if self.pairs is None:
            there = (self.counts > 0).astype(np.int32)
            self.pairs = np.convolve(there, there) > 0
        return self.pairs

    def two(self, gap: int, most: int | None = None) -> Iterator[tuple[int, int]]:
        """Available pairs with this sum, the longest first."""
        top = min(gap - 1, most or gap)
        longer = np.arange(top, (gap - 1) // 2, -1)
        for a in longer[(self.counts[longer] > 0) & (self.counts[gap - longer] > 0)].tolist():
            yield a, gap - a

    def three(self, gap: int) -> Iterator[tuple[int, int, int]]:
        firsts = np.arange(gap - 2, 0, -1)
        firsts = firsts[(self.counts[firsts] > 0) & self.pair_sums()[gap - firsts]]
        for a in firsts.tolist():
            for b, c in self.two(gap - a, a):
                yield a, b, c

    def filling(self, gap: int) -> Iterator[tuple[int, ...]]:
        if gap == 0:
            yield ()
            return
        if self.counts[gap]:
            yield (gap,)
        yield from self.two(gap)
        yield from self.three(gap)


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[Pattern]:
    """Sequences as (lengths, how often), from how many pieces there are of each length.

    Every step uses up a length (or leaves less than a combination needs), so there are
    at most a few times `capacity` patterns, however many pieces there are.
    """
    left = counts.astype(np.int64).copy()
    index, out = SumIndex(left), []
    for length in range(capacity, 0, -1):
        while left[length]:
            for rest in index.filling(capacity - length):
                times = index.take((length, *rest))
                if times:
                    out.append(((length, *rest), times))
                    break
            else:
                break
    bins: dict[int, list[list]] = {}
    for length in range(capacity, 0, -1):
        n = int(left[length])
        while n:
            gap = min((g for g, held in bins.items() if g >= length and held), default=None)
            if gap is None:
                each = capacity // length
                for k, times in ((each, n // each), (n % each, 1)):
                    if k and times:
                        bins.setdefault(capacity - k * length, []).append([(length,) * k, times])
                n = 0
            else:
                held, times = bins[gap].pop()
                used = min(n, times)
                if times > used:
                    bins[gap].append([held, times - used])
                bins.setdefault(gap - length, []).append([(*held, length), used])
                n -= used
    return out + [(held, times) for group in bins.values() for held, times in group]


def slots(patterns: list[Pattern], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """For each length, runs of ranks that go to one place of one pattern.

    `head[n]` to `head[n + 1]` are the runs of length n: the first rank, the sequence
    that it goes to (the next rank goes to the next) and the offset there.
    """
    runs: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    used, base = np.zeros(capacity + 1, dtype=np.int64), 0
    for lengths, times in patterns:
        offset = 0
        for n in lengths:
            runs[n].append((int(used[n]), base, offset))
            used[n] += times
            offset += n
        base += times
    flat = np.array([run for own in runs for run in own], dtype=np.int64).reshape(-1, 3)
    head = np.concatenate([[0], np.cumsum([len(own) for own in runs])])
    return {"head": head, "first": flat[:, 0], "sequence": flat[:, 1], "offset": flat[:, 2]}


def document_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode each document, add the end id and cut those longer than `capacity`.

    Pieces are full but for the first. A null text is empty: its piece is the end id.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coder = encoder(tokenizer)
            for part in slices(batch, "text", SLICE_BYTES):
                ids, bounds = coder.encode(part.column("text"))
                rows = []
                for doc, low, high in zip(part.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = np.append(ids[low:high], np.uint32(end_id)).astype("<u4")
                    start, number = 0, 0
                    while start < len(own):
                        stop = start + ((len(own) - start) % capacity or capacity)
                        rows.append((doc, number, start, stop - start, zlib.crc32(own[start:stop].tobytes())))
                        start, number = stop, number + 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                names = ("doc_id", "piece", "start", "length", "ids_crc32")
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to rows with doc_id, piece, ids_crc32 and length (1 to `capacity`).

    Repeated rows are packed as often as they come; an empty table gives no rows.
    Starts Spark jobs.
    """
    pieces = materialize(pieces, "pieces")
    sizes = materialize(pieces.groupBy("length").agg(F.count(F.lit(1)).alias("rows")), "lengths")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for row in sizes.collect():  # one row per length: at most `capacity`
        counts[row["length"]] = row["rows"]
    found = pieces.sparkSession.sparkContext.broadcast(slots(plan(counts, capacity), capacity))
    digest = F.xxhash64("doc_id", "piece", "ids_crc32")
    unit = F.shiftrightunsigned(digest, 11).cast("double") / 2**53
    ranked = pieces.join(sizes, "length").withColumn("bucket", bucket_of(unit, F.col("rows"))).drop("rows")
    ranked = add_before(ranked, ranked, "length", ("doc_id", "piece", "ids_crc32"), F.lit(1), "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = found.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            # Ranks of all lengths on one ascending line, so that one search finds all runs.
            line = np.repeat(np.arange(capacity + 1), np.diff(runs["head"])) * (1 << 45) + runs["first"]
            at = np.searchsorted(line, length * (1 << 45) + rank, side="right") - 1
            sequence = runs["sequence"][at] + rank - runs["first"][at]
            columns = [batch.column(c) for c in names] + [pa.array(sequence), pa.array(runs["offset"][at])]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*names, "rank").mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
