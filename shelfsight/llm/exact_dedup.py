"""Exact dedup by a Golomb-coded exchange of fingerprints.

Blocks of rows send owners the sorted, coded fingerprints of their texts; owners
answer with a bitmap of those that another block sent too. Only texts that the
bitmaps (or the block itself) call suspect are then shuffled, one per block and
text, and grouped by their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm import golomb
from shelfsight.llm.arrays import LOWER, buffers, slices
from shelfsight.llm.common import bloom, in_bloom, lowered, shuffle_partitions, without
from shelfsight.sources.scratch import materialize

#: Rows in one block, and fingerprints that one owner should hold.
BLOCK_ROWS, OWNER_KEYS = 1 << 16, 1 << 22


def _digests(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, memoryview, np.ndarray]:
    """Hex SHA-256, fingerprint (its first eight bytes) and bytes of each lowered text."""
    data, offsets = buffers(batch.column("text"))
    low = memoryview(LOWER[data])
    hexes = [hashlib.sha256(low[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    return hexes, np.array([int(h[:16], 16) for h in hexes], dtype=np.uint64), low, offsets


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, number, ids, hexes = TaskContext.get().partitionId(), 0, [], []

    def flush():
        row = [[(part << 20) + number], [ids], [hexes]]
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()))
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds)], names=["block", "ids", "hexes"])

    for batch in batches:
        for piece in slices(batch, "text"):
            ids.extend(piece.column("doc_id").to_pylist())
            hexes.extend(_digests(piece)[0])
            if len(ids) >= BLOCK_ROWS:
                yield flush()
                number, ids, hexes = number + 1, [], []
    if ids:
        yield flush()


def _known_elsewhere(keys: np.ndarray, sender: np.ndarray, extra: np.ndarray | None) -> tuple[np.ndarray, int]:
    """Did more than one block send the key? A block sends a key once."""
    distinct, inverse, times = np.unique(keys, return_inverse=True, return_counts=True)
    return times[inverse] > 1, len(distinct)


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Return doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs`.

    Texts are equal when their bytes are, A-Z lowered. Of equal texts the row with
    the largest id stays (a null id is the smallest; of rows that tie, one stays).
    A null text counts as empty, and all empty texts are one group; an empty table
    gives no rows. Other columns are not read. Starts Spark jobs.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    blocks = materialize(docs.mapInArrow(_blocks, "block long, ids array<long>, hexes array<string>"), "prints")
    rows = blocks.agg(F.sum(F.size("ids"))).first()[0] or 0
    partitions = shuffle_partitions(spark)
    owners = max(2 * partitions, -(-rows // OWNER_KEYS))

    def ask(batches):
        for batch in batches:
            for block, hexes in zip(batch.column("block").to_pylist(), batch.column("hexes").to_pylist()):
                prints = np.array([int(h[:16], 16) for h in hexes], dtype=np.uint64)
                yield golomb.request_batch(golomb.requests(block, np.unique(prints), owners))

    bitmaps = golomb.exchange(blocks.select("block", "hexes").mapInArrow(ask, golomb.REQUEST), _known_elsewhere, partitions, True)

    def mark(sent: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"doc_id": [], "hex": [], "row": [], "suspect": []}
        for block, ids, hexes in zip(*(sent.column(c).to_pylist() for c in ("block", "ids", "hexes"))):
            prints = np.array([int(h[:16], 16) for h in hexes], dtype=np.uint64)
            keys, inverse, times = np.unique(prints, return_inverse=True, return_counts=True)
            suspect = golomb.replies_of(answers, keys, owners, True) | (times > 1)
            out["doc_id"] += ids
            out["hex"] += hexes
            out["row"] += [(block << 20) + k for k in range(len(ids))]
            out["suspect"] += suspect[inverse].tolist()
        kinds = {"doc_id": pa.int64(), "hex": pa.string(), "row": pa.int64(), "suspect": pa.bool_()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    marked = materialize(
        blocks.groupBy("block")
        .cogroup(bitmaps.filter("block >= 0").groupBy("block"))
        .applyInArrow(mark, "doc_id long, hex string, row long, suspect boolean"),
        "marked",
    )
    alone, suspects = marked.filter(~F.col("suspect")), marked.filter("suspect")
    fingerprint = F.expr("cast(conv(substr(hex, 1, 16), 16, -10) as bigint)").alias("print")
    held = bloom(suspects.select(fingerprint).distinct(), "print")

    def suspect_texts(batches):
        for batch in batches:
            for piece in slices(batch, "text"):
                hexes, prints, low, offsets = _digests(piece)
                texts, counts = {}, {}
                for k in np.flatnonzero(in_bloom(held.value, prints.view(np.int64))).tolist():
                    text = bytes(low[offsets[k] : offsets[k + 1]])
                    texts[text] = hexes[k]
                    counts[text] = counts.get(text, 0) + 1
                columns = [pa.array(texts.values(), pa.string()), pa.array(texts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["hex", "bytes", "n"])

    # Copies are summed in each task before the shuffle, so a hot text travels once per task.
    verified = (
        docs.select("text")
        .mapInArrow(suspect_texts, "hex string, bytes binary, n long")
        .groupBy("hex", "bytes")
        .agg(F.sum("n").alias("n"))
        .select("hex", "n")
    )
    claimed = suspects.groupBy("hex").agg(
        F.count(F.lit(1)).alias("group_size"),
        F.max(F.struct(F.col("doc_id"), (-F.col("row")).alias("back"))).alias("last"),
    )
    groups = (
        claimed.join(verified, "hex")
        .withColumn(
            "group_size",
            F.when(F.col("n") == F.col("group_size"), F.col("group_size")).otherwise(
                F.raise_error(F.lit("different texts share one digest")).cast("long")
            ),
        )
        .select("hex", "group_size", F.col("last.doc_id").alias("keep_id"), (-F.col("last.back")).alias("keep_row"))
    )
    groups = materialize(groups, "groups")
    answer = ("doc_id", "keep_id", "group_size", "kept", F.col("hex").alias("text_sha256"), "row")
    together = suspects.join(groups, "hex").withColumn("kept", F.col("row") == F.col("keep_row")).select(*answer)
    single = alone.withColumns(
        {"keep_id": F.col("doc_id"), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)}
    ).select(*answer)
    return together.unionByName(single).drop("row")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` that `exact_groups` keeps, with all their columns."""
    key = [F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")]
    decided = materialize(
        exact_groups(docs, id_column, text_column)
        .filter("group_size > 1")
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_rows"), F.max("kept").alias("_kept")),
        "decided",
    )
    same = F.col(id_column).eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_sha"))
    keyed = docs.withColumn("_key", F.sha2(lowered(F.col(text_column)), 256))
    dropped = decided.filter("not _kept").select("_id", "_sha")
    chosen = without(keyed, dropped, same, F.xxhash64(F.col(id_column).cast("long"), "_key"), F.xxhash64("_id", "_sha"))
    repeats = decided.filter("_kept and _rows > 1")
    if repeats.isEmpty():
        return chosen.drop("_key")
    once = chosen.join(repeats, same, "left_semi").dropDuplicates([id_column, "_key"])
    return chosen.join(repeats, same, "left_anti").unionByName(once).drop("_key")
