"""Packing by minimum bin slack.

The packing is decided on the histogram of piece lengths, at most `capacity` counts.
Each window starts with the longest length that is left; a subset-sum program over a
bitset of reachable sums finds the multiset of remaining lengths that fills the rest
of the window closest to capacity, and backtracking reads off how many of each length
it takes. The multiset is used as often as the counts allow. Where it leaves a slack,
the longest remaining piece is cut to fill it and its rest goes back to the lengths.
What no window holds at the end is cut at powers of two, which need no padding.
Pieces find their places by their rank within their length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.arrays import slices
from shelfsight.llm.common import bloom, in_bloom
from shelfsight.llm.encode import SLICE_BYTES, encoder
from shelfsight.llm.ranks import add_before, bucket_of
from shelfsight.llm.records import pack_ids, unpack_ids
from shelfsight.sources.scratch import materialize

CAPACITY = 1024
#: Room for the ranks of one length on the line of all lengths.
RANKS = 1 << 45
#: Kinds of windows at most, in multiples of the capacity; what is left then is laid end to end.
MOST_KINDS = 16
PIECES = "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PLACED = (
    "row long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, inside long"
)


class Run(NamedTuple):
    """`count` pieces of one length, from rank `first`: of each, `size` ids from `inside` on.

    The first of them lies at `at`, each next one `stride` further, on the line of all windows.
    """

    length: int
    first: int
    count: int
    inside: int
    size: int
    at: int
    stride: int


def fill(left: list[int], room: int) -> dict[int, int]:
    """How many of each available length make the largest sum of at most `room`.

    Bit s of `reach` says that the lengths so far, longest first, can sum to s. Counts
    enter by binary splitting; the search ends once the room is filled exactly.
    Backtracking takes the shorter lengths only where the longer ones cannot do it.
    """
    inside, reach, steps = (1 << (room + 1)) - 1, 1, []
    for n in range(min(room, len(left) - 1), 0, -1):
        if not left[n]:
            continue
        steps.append((n, reach))
        most, part = min(left[n], room // n), 1
        while most:
            part = min(part, most)
            reach |= (reach << n * part) & inside
            most, part = most - part, part * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for n, before in reversed(steps):
        while not before >> total & 1:
            total -= n
            chosen[n] = chosen.get(n, 0) + 1
    return chosen


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[Run]:
    """Places on the line of all windows for every piece, from how many there are of each length.

    The windows lie end to end from 0 and leave no gap; a piece that crosses the end of a
    window continues in the next one.
    """
    left = [int(n) for n in counts]
    pools = [[(n, 0, left[n], 0)] if left[n] else [] for n in range(len(left))]
    runs: list[Run] = []

    def lay(n: int, times: int, at: int, stride: int, size: int):
        """Put the first `size` ids of `times` pieces of length n at `at` and on; the rest stays available."""
        left[n] -= times
        if size < n:
            left[n - size] += times
        while times:
            length, first, count, inside = pools[n].pop()
            used = min(count, times)
            if used < count:
                pools[n].append((length, first + used, count - used, inside))
            if size < n:
                pools[n - size].append((length, first, used, inside + size))
            runs.append(Run(length, first, used, inside, size, at, stride))
            at, times = at + used * stride, times - used

    position, longest = 0, capacity
    for _ in range(MOST_KINDS * capacity):
        longest = next((n for n in range(capacity, 0, -1) if left[n]), 0)
        if not longest:
            break
        left[longest] -= 1
        need = fill(left, capacity - longest)
        left[longest] += 1
        need[longest] = need.get(longest, 0) + 1
        gap = capacity - sum(n * k for n, k in need.items())
        # Every length that is left is longer than the gap, or it would have been taken.
        cut = next((n for n in range(capacity, 0, -1) if left[n] > need.get(n, 0)), 0) if gap else 0
        if gap and not cut:
            break
        wanted = need | ({cut: need.get(cut, 0) + 1} if gap else {})
        times = min(left[n] // k for n, k in wanted.items())
        at = position
        for n, k in sorted(need.items(), reverse=True):
            for _ in range(k):
                lay(n, times, at, capacity, n)
                at += n
        if gap:
            lay(cut, times, at, capacity, gap)
        position += times * capacity
    for n in range(capacity, 0, -1):
        while left[n]:
            times = pools[n][-1][2]
            lay(n, times, position, n, n)
            position += times * n
    return runs


class Places(NamedTuple):
    """The runs as arrays to search: ranks of all lengths on one ascending `line`."""

    line: np.ndarray
    head: np.ndarray
    inside: np.ndarray
    size: np.ndarray
    at: np.ndarray
    stride: np.ndarray
    ends: np.ndarray
    capacity: int


def places(runs: list[Run], capacity: int = CAPACITY) -> Places:
    """Cut the ranks of each length where any run starts or ends, and list the parts of each stretch."""
    own: dict[int, list[Run]] = {}
    for run in runs:
        own.setdefault(run.length, []).append(run)
    line, head, parts = [], [0], []
    for length in sorted(own):
        borders = sorted({r.first for r in own[length]} | {r.first + r.count for r in own[length]})
        number = {b: k for k, b in enumerate(borders)}
        stretch: list[list[tuple]] = [[] for _ in borders]
        for r in own[length]:
            for k in range(number[r.first], number[r.first + r.count]):
                stretch[k].append((r.inside, r.size, r.at + (borders[k] - r.first) * r.stride, r.stride))
        for border, found in zip(borders[:-1], stretch):
            line.append(length * RANKS + border)
            parts += sorted(found)
            head.append(len(parts))
    flat = np.array(parts, dtype=np.int64).reshape(-1, 4)
    total = sum(r.count * r.size for r in runs)
    full, rest = divmod(total, capacity)
    # The last window's content is cut at powers of two, the largest first.
    bits = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    ends = full * capacity + np.concatenate([[0], np.cumsum(bits)]).astype(np.int64)
    return Places(np.array(line, dtype=np.int64), np.array(head, dtype=np.int64), *flat.T.copy(), ends, capacity)


def sequence_of(found: Places, position: np.ndarray) -> np.ndarray:
    """The sequence that holds each place of the line."""
    tail = np.searchsorted(found.ends, position, side="right") - 1
    return np.where(position < found.ends[0], position // found.capacity, found.ends[0] // found.capacity + np.maximum(tail, 0))


def begin_of(found: Places, sequence: np.ndarray) -> np.ndarray:
    """Where each sequence (or the end behind the last one) begins on the line."""
    tail = np.clip(sequence - found.ends[0] // found.capacity, 0, len(found.ends) - 1)
    return np.where(sequence * found.capacity <= found.ends[0], sequence * found.capacity, found.ends[tail])


def placed(found: Places, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """For pieces given by length and rank: item, ids from, how many, sequence and offset of all their parts."""
    stretch = np.searchsorted(found.line, length * RANKS + rank, side="right") - 1
    since = length * RANKS + rank - found.line[stretch]
    item, part = expand(found.head[stretch], found.head[stretch + 1])
    at = found.at[part] + since[item] * found.stride[part]
    last = at + found.size[part]
    of_part, sequence = expand(sequence_of(found, at), sequence_of(found, last - 1) + 1)
    begin = np.maximum(at[of_part], begin_of(found, sequence))
    end = np.minimum(last[of_part], begin_of(found, sequence + 1))
    inside = found.inside[part][of_part] + begin - at[of_part]
    return item[of_part], inside, end - begin, sequence, begin - begin_of(found, sequence)


def expand(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All whole numbers of each range, with the number of their range."""
    sizes = high - low
    item = np.repeat(np.arange(len(low)), sizes)
    return item, np.arange(len(item)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)


def document_pieces(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Encode each document, add the end id and cut off full windows; the last piece may be shorter.

    A null text is empty: its piece is the end id. A null id stays null. Repeated rows are
    documents of their own. `row` tells all pieces apart. Other columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            coder = encoder(tokenizer)
            for part in slices(batch, "text", SLICE_BYTES):
                ids, bounds = coder.encode(part.column("text"))
                rows = []
                for doc, low, high in zip(part.column("doc_id").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = np.append(ids[low:high], np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(own), capacity):
                        piece = own[start : start + capacity]
                        rows.append((row, doc, start, len(piece), zlib.crc32(piece.tobytes()), len(own), pack_ids(piece)))
                        row += 1
                kinds = (*[pa.int64()] * 6, pa.binary())
                names = ("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids")
                columns = list(zip(*rows)) if rows else [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return chosen.mapInArrow(cut, PIECES)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Return doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, inside and row of all pieces.

    `pieces` is what `document_pieces` gives, each of 1 to `capacity` ids. A piece that the
    plan cuts comes in several rows, `inside` saying where in the piece it starts. All
    sequences are full, but for at most one of each power of two below `capacity`. Equal
    lengths are told apart by `row` only, so ties and repeated rows need no order of their
    own. An empty table gives no rows. Starts Spark jobs.
    """
    pieces = materialize(pieces, "pieces")
    slim = pieces.drop("ids")
    sizes = materialize(slim.groupBy("length").agg(F.count(F.lit(1)).alias("rows")).coalesce(1), "lengths")  # at most `capacity` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for size in sizes.collect():
        counts[size["length"]] = size["rows"]
    found = pieces.sparkSession.sparkContext.broadcast(places(plan(counts, capacity), capacity))
    unit = F.shiftrightunsigned(F.xxhash64("row"), 11).cast("double") / 2**53
    ranked = slim.join(sizes, "length").withColumn("bucket", bucket_of(unit, F.col("rows"))).drop("rows")
    ranked = add_before(ranked, ranked.select("length", "bucket"), "length", ("row",), F.lit(1), "rank")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            item, inside, size, sequence, offset = placed(found.value, length, batch.column("rank").to_numpy())
            of = batch.take(pa.array(item))
            whole = size == length[item]
            crc = pa.array(of.column("ids_crc32").to_numpy(), mask=~whole)
            start = pa.array(of.column("start").to_numpy() + inside)
            columns = [of.column("row"), of.column("doc_id"), start, pa.array(size), crc, of.column("doc_tokens")]
            columns += [pa.array(sequence), pa.array(offset), pa.array(inside)]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    names = ("row", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank")
    laid = materialize(ranked.select(*names).mapInArrow(place, PLACED), "places")
    # Only pieces that the plan cut need their ids again; a filter of fixed size keeps most others from moving.
    again = laid.filter("ids_crc32 is null")
    held = bloom(again.select(F.xxhash64("row").alias("key")).distinct(), "key")

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maybe = in_bloom(held.value, batch.column("key").to_numpy())
            yield batch.select(["row", "ids"]).filter(pa.array(maybe))

    ids = pieces.select("row", "ids", F.xxhash64("row").alias("key")).mapInArrow(wanted, "row long, ids binary")

    def checksum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crcs = [
                zlib.crc32(unpack_ids(ids)[low : low + n].astype("<u4").tobytes())
                for ids, low, n in zip(*(batch.column(c).to_pylist() for c in ("ids", "inside", "length")))
            ]
            columns = [pa.array(crcs, pa.int64()) if c == "ids_crc32" else batch.column(c) for c in NAMES]
            yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return laid.filter("ids_crc32 is not null").unionByName(again.join(ids, "row").select(*NAMES, "ids").mapInArrow(checksum, PLACED))


NAMES = [field.split()[0] for field in PLACED.split(", ")]
