"""Array code over the bytes of an Arrow text column: words, hashes, lines.

Texts stay in Arrow's buffer; nothing here makes a Python string per row. Words
are `[^\\x20\\x09-\\x0D]+`, and since those six bytes never occur inside a longer
UTF-8 character, words can be cut on bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text handled at once; a longer single text is handled alone.
SLICE_BYTES = 1 << 20

_RANDOM = np.random.Generator(np.random.PCG64(20240917))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
_TABLES: dict[int, np.ndarray] = {}

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(n: int, base: int = int(_STEP)) -> np.ndarray:
    """The first `n` powers of a hash multiplier, modulo 2^64."""
    if len(_TABLES.get(base, ())) < n:
        grown = np.full(max(n, 1 << 12), base, dtype=np.uint64)
        grown[0] = 1
        _TABLES[base] = np.multiply.accumulate(grown)
    return _TABLES[base][:n]


def buffers(column: pa.Array | pa.ChunkedArray, binary: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text (or binary) column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = offsets[0] if len(offsets) else 0
    return data[first : offsets[-1]], offsets - first


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most `limit` text bytes, or one row.

    After a batch, what Arrow and the C heap still hold of it goes back to the system,
    as a worker lives on through many tasks.
    """
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + limit, side="right")), start + 1)
        yield batch.slice(start, stop - start)
        start = stop
    release()


def release() -> None:
    """Hand freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the row it is in; words end at row ends."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and do not overlap."""
    sizes = ends - starts
    if len(data) <= 4 * SLICE_BYTES:
        # A difference of running sums, moved back to the start of its span.
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * powers(len(data)), out=sums[1:])
        back = powers(len(data) + 1, pow(int(_STEP), -1, 1 << 64))
        total = (sums[ends] - sums[starts]) * back[starts]
    else:
        # One very long text: the same value span by span, without tables of its length.
        total = np.zeros(len(starts), dtype=np.uint64)
        full = np.flatnonzero(sizes > 0)
        for low in range(0, len(full), 1 << 16):
            some = full[low : low + (1 << 16)]
            lengths = sizes[some]
            heads = np.cumsum(lengths) - lengths
            place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(heads, lengths)
            at = place + np.repeat(starts[some], lengths)
            total[some] = np.add.reduceat(_BYTE[data[at]] * powers(int(lengths.max()))[place], heads)
    return mix(total ^ (sizes.astype(np.uint64) * _STEP))


def gram_hashes(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every window of `n` words that stays in one row."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(rows[:count] == rows[n - 1 :])
    total = np.zeros(len(at), dtype=np.uint64)
    for k in range(n):
        total = total * _STEP + hashes[at + k]
    return mix(total), at


def firsts(rows: np.ndarray, n_rows: int) -> np.ndarray:
    """Where each row's items start in `rows` (ascending), with the end at last."""
    return np.searchsorted(rows, np.arange(n_rows + 1))


def repeated(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each item: does its key occur elsewhere in the same row?"""
    out = np.zeros(len(keys), dtype=bool)
    if len(keys) > 1:
        order = np.lexsort((keys, rows))
        same = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
        out[order[1:]] |= same
        out[order[:-1]] |= same
    return out


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed longs."""
    return np.ascontiguousarray(h).view(np.int64)
