"""Removal of byte strings that also start in an earlier document, by sorted suffixes.

A string of LENGTH bytes is told by the smallest hash among its k-grams (the leftmost
of equal ones), so equal strings have equal anchors at equal places. A suffix is what
follows an anchor; with the few bytes before it, it holds every string that the anchor
tells. Steps:

1. Texts go into compressed blocks. Rows whose whole text an earlier row has are
   found by exchanged digests; of equal texts only the first goes on.
2. Blocks exchange short anchor hashes; a bitmap says which anchors two blocks or two
   texts share. Other anchors cannot tell a repeated string and are left.
3. The suffixes of shared anchors are range-partitioned by their leading k bytes at
   splitters that Spark samples. Each bucket sorts its strings by multikey quicksort,
   eight bytes at a time, and finds the smallest id of each run of equal strings. A
   splitter never divides suffixes with the same leading bytes, so what two buckets
   would have to compare across their boundary is always in one of them.
4. Strings of larger ids become spans, joined with the texts that have any.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm import golomb
from shelfsight.llm.arrays import _BYTE, buffers, mix, slices
from shelfsight.llm.common import shuffle_partitions
from shelfsight.sources.scratch import materialize

LENGTH, GRAM = 50, 24
#: Text of a block, of an array step, strings sorted at once, and bits of an anchor's short hash.
BLOCK_BYTES, STEP_BYTES, SORTED, SHORT_BITS = 4 << 20, 1 << 19, 1 << 18, 40
OWNER_KEYS = 1 << 20
#: Rows of one block; a row's number is its block's number and its place in 20 bits.
BLOCK_ROWS = 1 << 16
_SIGN = 1 << 63
#: Bytes of a holder (row, place of the anchor, id), and bits of a place within a text.
HOLDER, PLACE_BITS = 24, 36
_STEP = 0x9E3779B97F4A7C15 | 1
EMPTY = hashlib.sha256(b"").hexdigest()
BLOCK = "block long, ids array<long>, sizes array<long>, hexes array<string>, text binary"
MARKED = (
    "row long, doc_id long, n_bytes long, hex string, covered boolean, text binary, "
    "context binary, before int, holders binary"
)


def _rank(ids: list[int | None]) -> np.ndarray:
    """Ids as uint64 in the same order; null is the smallest."""
    return np.array([0 if i is None else i + _SIGN for i in ids], dtype=np.uint64)


def gram_hash(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes that start at each place."""
    h, parts, size = _BYTE[data], {}, 1
    while True:
        parts[size] = h
        if 2 * size > GRAM:
            break
        h = h[:-size] * np.uint64(pow(_STEP, size, 1 << 64)) + h[size:]
        size *= 2
    n, total, done = len(data) - GRAM + 1, None, 0
    for size in sorted(parts, reverse=True):
        if GRAM - done >= size:
            part = parts[size][done : done + n]
            total = part if total is None else total * np.uint64(pow(_STEP, size, 1 << 64)) + part
            done += size
    return mix(total)


def anchors(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Each anchor's place and hash, and the first and last string that it tells."""
    width = LENGTH - GRAM + 1
    if len(data) < LENGTH:
        return {c: np.zeros(0, np.uint64 if c == "hash" else np.int64) for c in ("place", "hash", "first", "last")}
    h = gram_hash(data)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while 2 * size <= width:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    n = len(h) - width + 1
    told = (np.minimum(low[:n], low[width - size : width - size + n]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    # Strings that would reach into the next text tell nothing.
    inside = np.zeros(len(data) + 1, dtype=np.int32)
    sizes = np.diff(offsets)
    full = sizes >= LENGTH
    np.add.at(inside, offsets[:-1][full], 1)
    np.add.at(inside, offsets[1:][full] - LENGTH + 1, -1)
    strings = np.flatnonzero(np.cumsum(inside)[:n] > 0)
    told = told[strings]
    new = np.ones(len(told), dtype=bool)
    new[1:] = (told[1:] != told[:-1]) | (strings[1:] != strings[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(told)) - 1
    if not len(told):
        last = first
    return {"place": told[first], "hash": h[told[first]], "first": strings[first], "last": strings[last]}


def _steps(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of texts of about STEP_BYTES."""
    ends, start = np.cumsum(sizes), 0
    while start < len(sizes):
        before = int(ends[start - 1]) if start else 0
        stop = max(int(np.searchsorted(ends, before + STEP_BYTES, side="right")), start + 1)
        yield start, stop
        start = stop


def _make_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, held = TaskContext.get().partitionId(), 0, {"ids": [], "sizes": [], "hexes": [], "text": []}
    kinds = {"block": pa.int64(), "ids": pa.list_(pa.int64()), "sizes": pa.list_(pa.int64()), "hexes": pa.list_(pa.string()), "text": pa.binary()}

    def flush() -> pa.RecordBatch:
        text = zstandard.ZstdCompressor(level=3).compress(b"".join(held["text"]))
        row = {**held, "block": (part << 20) + number, "text": text}
        return pa.RecordBatch.from_arrays([pa.array([row[c]], kinds[c]) for c in kinds], names=list(kinds))

    for batch in batches:
        for piece in (part.slice(low, BLOCK_ROWS) for part in slices(batch, "text", STEP_BYTES) for low in range(0, part.num_rows, BLOCK_ROWS)):
            data, offsets = buffers(piece.column("text"))
            raw = memoryview(np.ascontiguousarray(data))
            held["text"].append(raw.tobytes())
            held["ids"] += piece.column("doc_id").to_pylist()
            held["sizes"] += np.diff(offsets).tolist()
            held["hexes"] += [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            if sum(map(len, held["text"])) >= BLOCK_BYTES or len(held["ids"]) >= BLOCK_ROWS:
                yield flush()
                number += 1
                held = {c: [] for c in held}
    if held["ids"]:
        yield flush()


def _halves(hexes: list[str]) -> np.ndarray:
    """Both first eight-byte words of each digest, the digest's row in columns."""
    return np.array([[int(h[:16], 16), int(h[16:32], 16)] for h in hexes], dtype=np.uint64).reshape(-1, 2)


def _smallest(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the smallest value of each."""
    order = np.lexsort((values, keys))
    keys, values = keys[order], values[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = keys[1:] != keys[:-1]
    return keys[new], values[new]


def _first_holder(keys: np.ndarray, sender: np.ndarray, extra: np.ndarray | None) -> tuple[np.ndarray, int]:
    distinct, lowest = _smallest(keys, extra.view(np.uint64))
    return lowest[np.searchsorted(distinct, keys)], len(distinct)


def _shared(keys: np.ndarray, sender: np.ndarray, extra: np.ndarray | None) -> tuple[np.ndarray, int]:
    """Sent by two blocks, or by one that has it in two texts?"""
    order = np.argsort(keys)
    keys = keys[order]
    heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
    times = np.diff(np.append(heads, len(keys)))
    several = (np.maximum.reduceat(extra[order], heads) > 0) | (times > 1) if len(keys) else times > 1
    out = np.empty(len(keys), dtype=bool)
    out[order] = np.repeat(several, times)
    return out, len(heads)


def _block_anchors(row: dict, covered: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, dict]]:
    """For runs of a block's texts: first text, bytes, offsets and the anchors of texts not covered."""
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["text"]), dtype=np.uint8) if row["text"] else np.zeros(0, np.uint8)
    sizes = np.array(row["sizes"], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for a, b in _steps(sizes):
        part, offsets = data[starts[a] : starts[b]], starts[a : b + 1] - starts[a]
        found = anchors(part, offsets)
        found["text"] = np.searchsorted(offsets, found["first"], side="right") - 1
        use = ~covered[a:b][found["text"]] if len(found["text"]) else np.zeros(0, dtype=bool)
        yield a, part, offsets, {c: v[use] for c, v in found.items()}


def _short(h: np.ndarray) -> np.ndarray:
    return h & ~np.uint64((1 << (64 - SHORT_BITS)) - 1)


def _binary(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Spans of bytes, which may overlap, as an Arrow column."""
    sizes = stops - starts
    ends = np.concatenate([[0], np.cumsum(sizes)])
    at = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data[at]))])


def _nothing(n: int, kind: pa.DataType) -> pa.Array:
    return pa.nulls(n, kind)


_KINDS = {
    "row": pa.int64(), "doc_id": pa.int64(), "n_bytes": pa.int64(), "hex": pa.string(), "covered": pa.bool_(), "text": pa.binary(),
    "context": pa.binary(), "before": pa.int32(), "holders": pa.binary(),
}


def _rows(n: int, **columns) -> pa.Table:
    return pa.table({c: columns.get(c, _nothing(n, k)) for c, k in _KINDS.items()})


def sort_strings(strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort of fixed-length byte strings, eight bytes a level.

    Returns the order and, in that order, the number of each run of equal strings. Every
    level sorts only what the levels before left tied.
    """
    n, width = strings.shape
    words = np.zeros((n, -(-width // 8) * 8), dtype=np.uint8)
    words[:, :width] = strings
    words = words.view(">u8")
    order = np.argsort(words[:, 0], kind="quicksort")
    first = words[order, 0]
    run = np.cumsum(np.concatenate([[0], first[1:] != first[:-1]])) if n else np.zeros(0, np.int64)
    for level in range(1, words.shape[1]):
        sizes = np.bincount(run)
        tied = np.flatnonzero(sizes[run] > 1)
        if not len(tied):
            break
        keys = words[order[tied], level]
        inner = np.lexsort((keys, run[tied]))
        order[tied] = order[tied][inner]
        keys = keys[inner]
        new = np.zeros(n, dtype=np.int64)
        new[tied[1:]] = (keys[1:] != keys[:-1]) & (run[tied][1:] == run[tied][:-1])
        run = run + np.cumsum(new)
        _, run = np.unique(run, return_inverse=True)
    return order, run


def _ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of these sizes: the group of each item and its number in it."""
    group = np.repeat(np.arange(len(counts)), counts)
    heads = np.cumsum(counts) - counts
    return group, np.arange(int(counts.sum())) - heads[group]


def repeated_spans(suffixes: pa.Table) -> pa.Table:
    """Spans of strings that a smaller id has, from suffixes that share leading bytes."""
    context, offsets = buffers(suffixes.column("context"), binary=True)
    strings_of = np.diff(offsets) - (LENGTH - 1)
    left = suffixes.column("before").to_numpy()
    raw, bounds = buffers(suffixes.column("holders"), binary=True)
    holders = np.diff(bounds) // HOLDER
    held = np.frombuffer(raw.tobytes(), dtype=np.uint64).reshape(-1, 3)
    rows, number_of = np.unique(held[:, 0].astype(np.int64), return_inverse=True)
    # One ascending line for all places: the row's number here, then the place in its text.
    place, doc = (number_of << PLACE_BITS) + held[:, 1].astype(np.int64), held[:, 2]
    owner, number = _ragged(strings_of)
    strings = np.lib.stride_tricks.sliding_window_view(context, LENGTH)[offsets[:-1][owner] + number]
    order, run = sort_strings(strings)
    head = np.cumsum(holders) - holders
    lowest_here = np.minimum.reduceat(doc, head) if len(doc) else doc
    runs = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else run
    lowest = np.minimum.reduceat(lowest_here[owner[order]], runs) if len(runs) else lowest_here
    first_id = np.empty(len(order), dtype=np.uint64)
    first_id[order] = lowest[run]
    # Each string of each holder of its suffix.
    item, k = _ragged(holders[owner])
    which = head[owner[item]] + k
    gone = first_id[item] < doc[which]
    item, which = item[gone], which[gone]
    begin = place[which] - left[owner[item]] + number[item]
    begin = np.unique(begin)
    new = np.concatenate([[True], begin[1:] != begin[:-1] + 1]) if len(begin) else np.zeros(0, bool)
    heads = np.flatnonzero(new)
    lasts = np.append(heads[1:], len(begin))[: len(heads)] - 1
    low = (1 << PLACE_BITS) - 1
    return pa.table({"row": rows[begin[heads] >> PLACE_BITS], "start": begin[heads] & low, "stop": (begin[lasts] & low) + LENGTH})


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Take a sorted bucket in runs of whole leading keys."""
    held: list[pa.RecordBatch] = []

    def leading(rows: pa.RecordBatch) -> list[bytes]:
        pairs = zip(rows.column("context").to_pylist(), rows.column("before").to_pylist())
        return [text[at : at + GRAM] for text, at in pairs]

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        context, offsets = buffers(rows.column("context"), binary=True)
        heads = offsets[:-1] + rows.column("before").to_numpy()
        key = np.lib.stride_tricks.sliding_window_view(context, GRAM)[heads]
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])
        holders = np.diff(buffers(rows.column("holders"), binary=True)[1]) // HOLDER
        # A leading key that one text alone has repeats nothing.
        useful = np.flatnonzero(np.bincount(group, weights=holders)[group] > 1)
        sizes = np.diff(offsets) - (LENGTH - 1)
        while len(useful):
            total = np.cumsum(sizes[useful])
            stop = int(np.searchsorted(total, SORTED)) + 1
            if stop < len(useful):  # not within a key
                same = np.flatnonzero(group[useful] == group[useful[stop - 1]])
                stop = int(same[-1]) + 1
            for batch in repeated_spans(rows.take(useful[:stop])).to_batches():
                yield batch
            useful = useful[stop:]

    for batch in batches:
        if not batch.num_rows:
            continue
        keys = leading(batch)
        last = keys[-1]
        whole = len(keys)
        while whole and keys[whole - 1] == last:
            whole -= 1
        if whole:
            held.append(batch.slice(0, whole))
            yield from work(pa.Table.from_batches(held))
            held = []
        elif held and leading(held[-1].slice(held[-1].num_rows - 1))[0] != last:
            yield from work(pa.Table.from_batches(held))
            held = []
        held.append(batch.slice(whole))
    if held:
        yield from work(pa.Table.from_batches(held))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, starts, stops in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "stops"))):
            text, kept, at, spans = zstandard.ZstdDecompressor().decompress(text), [], 0, 0
            for start, stop in sorted(zip(starts, stops)):
                if start > at or not spans:
                    kept.append(text[at:start])
                    spans += 1
                at = max(at, stop)
            kept = b"".join([*kept, text[at:]])
            out.append((len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
        columns = list(zip(*out)) if out else [[]] * 3
        kinds = (pa.int64(), pa.int64(), pa.string())
        done = [batch.column("doc_id"), batch.column("n_bytes"), *[pa.array(c, k) for c, k in zip(columns, kinds)]]
        yield pa.RecordBatch.from_arrays(done, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return doc_id, n_bytes, n_removed, n_spans and kept_sha256 for every row of `docs`.

    A null text is empty. A null id is smaller than any other. Rows with equal ids remove
    nothing from each other. Texts shorter than LENGTH bytes lose nothing. An empty table
    gives no rows. Other columns are not read. Starts Spark jobs.
    """
    spark = docs.sparkSession
    partitions = shuffle_partitions(spark)
    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    blocks = materialize(chosen.mapInArrow(_make_blocks, BLOCK), "blocks")
    sums = blocks.agg(F.sum(F.size("ids")), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    rows, size = sums[0] or 0, sums[1] or 0
    owners = [max(2 * partitions, -(-n // OWNER_KEYS)) for n in (2 * rows, size // 14)]

    def ask_digests(batches):
        for batch in batches:
            for block, ids, hexes in zip(*(batch.column(c).to_pylist() for c in ("block", "ids", "hexes"))):
                keys, lowest = _smallest(_halves(hexes).ravel(), np.repeat(_rank(ids), 2))
                yield golomb.request_batch(golomb.requests(block, keys, owners[0], lowest))

    digests = golomb.exchange(blocks.select("block", "ids", "hexes").mapInArrow(ask_digests, golomb.REQUEST), _first_holder, partitions)

    def find_covered(sent: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for ids, hexes in zip(sent.column("ids").to_pylist(), sent.column("hexes").to_pylist()):
            halves, own = _halves(hexes), _rank(ids)
            keys, _ = _smallest(halves.ravel(), np.repeat(own, 2))
            lowest = golomb.replies_of(answers, keys, owners[0]).view(np.uint64)[np.searchsorted(keys, halves)]
            out.append(((lowest[:, 0] == lowest[:, 1]) & (lowest[:, 0] < own)).tolist())
        return pa.table({"block": sent.column("block"), "covered": pa.array(out, pa.list_(pa.bool_()))})

    covered = materialize(
        blocks.select("block", "ids", "hexes")
        .groupBy("block")
        .cogroup(digests.filter("block >= 0").groupBy("block"))
        .applyInArrow(find_covered, "block long, covered array<boolean>"),
        "covered",
    )

    def block_rows(source) -> Iterator[dict]:
        for k in range(source.num_rows):
            yield source.slice(k, 1).to_pylist()[0]

    def short_keys(found: list[dict], first_texts: list[int]) -> tuple[np.ndarray, np.ndarray]:
        keys = np.concatenate([_short(f["hash"]) for f in found]) if found else np.zeros(0, np.uint64)
        texts = np.concatenate([f["text"] + a for f, a in zip(found, first_texts)]) if found else np.zeros(0, np.int64)
        order = np.argsort(keys, kind="stable")
        keys, texts = keys[order], texts[order]
        new = np.ones(len(keys), dtype=bool)
        new[1:] = keys[1:] != keys[:-1]
        heads = np.flatnonzero(new)
        if not len(heads):
            return keys, texts
        return keys[heads], (np.minimum.reduceat(texts, heads) != np.maximum.reduceat(texts, heads)).astype(np.int64)

    def ask_anchors(batches):
        for batch in batches:
            for row in block_rows(batch):
                found = _block_anchors(row, np.array(row["covered"], dtype=bool))
                runs = [(a, {c: f[c] for c in ("hash", "text")}) for a, _, _, f in found]
                keys, several = short_keys([f for _, f in runs], [a for a, _ in runs])
                yield golomb.request_batch(golomb.requests(row["block"], keys, owners[1], several))

    known = blocks.select("block", "sizes", "text").join(covered, "block")
    shared = golomb.exchange(known.mapInArrow(ask_anchors, golomb.REQUEST), _shared, partitions, True)

    def mark(sent: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for row in block_rows(sent):
            hidden, ranks = np.array(row["covered"], dtype=bool), _rank(row["ids"])
            runs = list(_block_anchors(row, hidden))
            keys, _ = short_keys([r[3] for r in runs], [r[0] for r in runs])
            flags = golomb.replies_of(answers, keys, owners[1], True)
            first_row, texts = row["block"] << 20, [None] * len(ranks)
            for a, data, offsets, found in runs:
                use = flags[np.searchsorted(keys, _short(found["hash"]))] if len(keys) else np.zeros(0, bool)
                found = {c: v[use] for c, v in found.items()}
                for k in np.unique(found["text"]).tolist():
                    texts[a + k] = zstandard.ZstdCompressor(level=3).compress(data[offsets[k] : offsets[k + 1]].tobytes())
                if len(found["place"]):
                    out.append(_suffix_rows(data, offsets, found, first_row + a, ranks[a:]))
            out.append(
                _rows(
                    len(ranks), row=pa.array(first_row + np.arange(len(ranks))), doc_id=pa.array(row["ids"], pa.int64()),
                    n_bytes=pa.array(row["sizes"], pa.int64()), hex=pa.array(row["hexes"], pa.string()),
                    covered=pa.array(hidden), text=pa.array(texts, pa.binary()),
                )
            )
        return pa.concat_tables(out)

    marked = materialize(
        blocks.join(covered, "block")
        .groupBy("block")
        .cogroup(shared.filter("block >= 0").groupBy("block"))
        .applyInArrow(mark, MARKED),
        "marked",
        compression="zstd",
    )
    lead = F.expr(f"substring(context, before + 1, {GRAM})")
    spans = (
        marked.filter("context is not null")
        .select("context", "before", "holders")
        .repartitionByRange(lead)
        .sortWithinPartitions(lead)
        .mapInArrow(_bucket, "row long, start long, stop long")
        .groupBy("row")
        .agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    )
    texts = marked.filter("n_bytes is not null")
    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    suspects = texts.filter("text is not null").select("row", "doc_id", "n_bytes", "text").join(spans, "row", "left")
    none = F.array().cast("array<long>")
    cut = suspects.select(
        "doc_id", "n_bytes", "text", F.coalesce("starts", none).alias("starts"), F.coalesce("stops", none).alias("stops")
    ).mapInArrow(_cut, result)
    whole = F.col("covered") & (F.col("n_bytes") >= LENGTH)
    plain = texts.filter("text is null").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"),
        whole.cast("long").alias("n_spans"),
        F.when(whole, F.lit(EMPTY)).otherwise(F.col("hex")).alias("kept_sha256"),
    )
    return cut.unionByName(plain)


def _suffix_rows(data: np.ndarray, offsets: np.ndarray, found: dict, first_row: int, ranks: np.ndarray) -> pa.Table:
    """One row per distinct suffix and what stands before it, with its holders: row, place and id of each."""
    begin, stop = found["first"], found["last"] + LENGTH
    # Equal contexts have equal sizes and equal grams at steps that leave no byte out.
    h = gram_hash(data)
    sign = h[begin] * np.uint64(3) + h[found["place"]]
    sign = mix(sign) + h[stop - GRAM] + mix((found["place"] - begin).astype(np.uint64) * np.uint64(4096) + (stop - begin).astype(np.uint64))
    for step in range(GRAM, 2 * LENGTH - GRAM, GRAM):
        sign = mix(sign) + h[np.minimum(begin + step, stop - GRAM)]
    order = np.argsort(sign, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = sign[order][1:] != sign[order][:-1]
    # Rows go out in the order of the text, where neighbours overlap and compress well.
    heads = np.flatnonzero(new)
    turn = np.empty(len(heads), dtype=np.int64)
    turn[np.argsort(order[heads])] = np.arange(len(heads))
    own = turn[np.cumsum(new) - 1]
    order = order[np.argsort(own, kind="stable")]
    heads = np.concatenate([[0], np.cumsum(np.bincount(own))]).astype(np.int32)
    one = order[heads[:-1]]
    texts = found["text"]
    holders = np.empty((len(order), 3), dtype=np.uint64)
    holders[:, 0] = (first_row + texts)[order]
    holders[:, 1] = (found["place"] - offsets[texts])[order]
    holders[:, 2] = ranks[texts][order]
    raw = pa.py_buffer(np.ascontiguousarray(holders))
    return _rows(
        len(one),
        context=_binary(data, begin[one], stop[one]),
        before=pa.array((found["place"] - begin)[one].astype(np.int32)),
        holders=pa.Array.from_buffers(pa.binary(), len(one), [None, pa.py_buffer(heads * HOLDER), raw]),
    )
