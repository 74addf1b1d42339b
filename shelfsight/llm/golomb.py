"""Golomb-Rice coding of sorted 64-bit hashes, and the exchange that uses it.

A block of rows sends each owner its distinct hashes of the owner's range, sorted
and coded by their gaps; the owner answers with one value per hash, in the order
in which the block sent them, so an answer needs no hashes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUEST = "owner int, block long, n long, rice int, keys binary, extra binary"
REPLY = "block long, owner int, reply binary"


def encode(keys: np.ndarray) -> tuple[int, bytes]:
    """Code ascending, distinct uint64 values: unary quotients, then fixed-width remainders."""
    if not len(keys):
        return 0, b""
    gaps = np.diff(keys, prepend=np.uint64(0))
    gaps[0] = keys[0]
    mean = float(gaps.astype(np.float64).mean())
    rice = max(0, min(63, int(np.log2(mean * 0.69 + 1))))
    quotients = (gaps >> np.uint64(rice)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1, dtype=np.uint8)
    unary[ends] = 1
    parts = [np.packbits(unary).tobytes()]
    if rice:
        # Whole bytes of the remainders as byte planes, the odd bits packed.
        rest = gaps & np.uint64((1 << rice) - 1)
        for k in range(rice // 8):
            parts.append(((rest >> np.uint64(8 * k)) & np.uint64(255)).astype(np.uint8).tobytes())
        odd = rice % 8
        if odd:
            top = (rest >> np.uint64(8 * (rice // 8))).astype(np.uint8)
            bits = (top[:, None] >> np.arange(odd, dtype=np.uint8)) & 1
            parts.append(np.packbits(bits.ravel()).tobytes())
    head = np.array([len(parts[0])], dtype="<i8").tobytes()
    return rice, head + b"".join(parts)


def decode(n: int, rice: int, blob: bytes) -> np.ndarray:
    """The values that `encode` was given."""
    if not n:
        return np.zeros(0, dtype=np.uint64)
    unary_size = int(np.frombuffer(blob, dtype="<i8", count=1)[0])
    at = 8
    unary = np.unpackbits(np.frombuffer(blob, dtype=np.uint8, count=unary_size, offset=at))
    at += unary_size
    ends = np.flatnonzero(unary)[:n]
    gaps = (np.diff(ends, prepend=-1) - 1).astype(np.uint64) << np.uint64(rice)
    for k in range(rice // 8):
        gaps |= np.frombuffer(blob, dtype=np.uint8, count=n, offset=at).astype(np.uint64) << np.uint64(8 * k)
        at += n
    odd = rice % 8
    if odd:
        bits = np.unpackbits(np.frombuffer(blob, dtype=np.uint8, offset=at))[: n * odd].reshape(n, odd)
        top = (bits << np.arange(odd, dtype=np.uint8)).sum(axis=1).astype(np.uint64)
        gaps |= top << np.uint64(8 * (rice // 8))
    return np.cumsum(gaps, dtype=np.uint64)


def pack_numbers(values: np.ndarray) -> bytes:
    """Non-negative numbers as compressed byte planes; small ones take about a byte."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def unpack_numbers(blob: bytes) -> np.ndarray:
    """The numbers that `pack_numbers` was given, as int64."""
    width = blob[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<i8").ravel()


def owner_of(keys: np.ndarray, owners: int) -> np.ndarray:
    """The owner of each uint64 key: the high word of key * owners, below 2^31 owners."""
    half, share = np.uint64(32), np.uint64(owners)
    low = ((keys & np.uint64(0xFFFFFFFF)) * share) >> half
    return (((keys >> half) * share + low) >> half).astype(np.int64)


def cuts(keys: np.ndarray, owners: int) -> tuple[np.ndarray, np.ndarray]:
    """The owners that ascending keys have, and where the keys of each start."""
    return np.unique(owner_of(keys, owners), return_index=True)


def requests(block: int, keys: np.ndarray, owners: int, extra: np.ndarray | None = None) -> list[tuple]:
    """The rows by which one block asks the owners of its ascending, distinct keys."""
    present, at = cuts(keys, owners)
    out = []
    for owner, low, high in zip(present.tolist(), at.tolist(), [*at[1:].tolist(), len(keys)]):
        rice, blob = encode(keys[low:high])
        more = b"" if extra is None else pack_numbers(extra[low:high])
        out.append((owner, block, high - low, rice, blob, more))
    return out


def request_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
    names = ("owner", "block", "n", "rice", "keys", "extra")
    columns = list(zip(*rows)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def exchange(
    asked: DataFrame,
    answer: Callable[[np.ndarray, np.ndarray, np.ndarray | None], tuple[np.ndarray, int]],
    partitions: int,
    bitmap: bool = False,
) -> DataFrame:
    """Bring each owner its requests and send back one answer per key.

    `answer(keys, sender, extra)` gets all keys that the owner was sent, the number of
    the sender of each and the number sent along with it; it returns one value per key
    and a number that is kept in a row with block -1. With `bitmap` the values are
    flags and travel as bits.
    """

    def owner_work(group: pa.Table) -> pa.Table:
        blocks = group.column("block").to_numpy()
        counts = group.column("n").to_numpy()
        rices = group.column("rice").to_numpy()
        ends = np.cumsum(counts)
        keys = np.empty(int(ends[-1]), dtype=np.uint64)
        extra = np.empty(len(keys), dtype=np.int64) if len(group.column("extra")[0].as_py()) else None
        for n, end, rice, blob, more in zip(counts, ends, rices, group.column("keys"), group.column("extra")):
            keys[end - n : end] = decode(n, rice, blob.as_py())
            if extra is not None:
                extra[end - n : end] = unpack_numbers(more.as_py())
        sender = np.repeat(np.arange(len(blocks), dtype=np.int32), counts)
        value, tally = answer(keys, sender, extra)
        code = (lambda v: np.packbits(v).tobytes()) if bitmap else pack_numbers
        replies = [code(value[e - n : e]) for n, e in zip(counts, ends)] + [str(tally).encode()]
        owner = group.column("owner").to_pylist()
        columns = {"block": [*blocks.tolist(), -1], "owner": [*owner, owner[0]], "reply": replies}
        kinds = {"block": pa.int64(), "owner": pa.int32(), "reply": pa.binary()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in columns.items()})

    return asked.repartition(partitions, F.col("owner")).groupBy("owner").applyInArrow(owner_work, REPLY)


def replies_of(group: pa.Table, keys: np.ndarray, owners: int, bitmap: bool = False) -> np.ndarray:
    """The answers to one block's ascending `keys`."""
    present, at = cuts(keys, owners)
    ends = np.append(at[1:], len(keys))
    out = np.zeros(len(keys), dtype=bool if bitmap else np.int64)
    answered = np.searchsorted(present, group.column("owner").to_numpy())
    for low, high, blob in zip(at[answered].tolist(), ends[answered].tolist(), group.column("reply").to_pylist()):
        out[low:high] = np.unpackbits(np.frombuffer(blob, np.uint8))[: high - low] if bitmap else unpack_numbers(blob)
    return out


def tally_of(replies: DataFrame) -> int:
    """The sum of the owners' own numbers."""
    blobs = replies.filter("block = -1").select(F.col("reply").cast("string").cast("long").alias("n"))
    return int(blobs.agg(F.sum("n")).first()[0] or 0)
