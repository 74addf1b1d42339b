"""Token ids as length-delimited binary records with masked checksums and an offset index.

A record is: the payload's length (8 bytes, little-endian), the masked CRC-32 of
those 8 bytes, the payload, and the masked CRC-32 of the payload. The payload is
one byte for the width of an id (2 or 4) and the ids, little-endian. Tasks write
one file each to a shared folder under a name of their own attempt; the index, a
Parquet table that Spark commits, names only files of attempts that succeeded.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.llm.arrays import slices
from shelfsight.llm.encode import SLICE_BYTES, encoder
from shelfsight.sources.scratch import materialize, scratch_path

#: Added to a rotated checksum, so that checksums of data holding checksums stay apart.
MASK_DELTA = 0xA282EAD8
INDEX = "doc_id long, file string, part int, at long, size long, start long, n_tokens long"


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked(zlib.crc32(head))) + payload + struct.pack("<I", masked(zlib.crc32(payload)))


def unframe(record: bytes) -> bytes:
    """The payload; an error if a length or checksum does not fit."""
    (size,), (head,) = struct.unpack_from("<Q", record), struct.unpack_from("<I", record, 8)
    payload = record[12 : 12 + size]
    if masked(zlib.crc32(record[:8])) != head or len(record) != size + 16:
        raise ValueError("a record's length is damaged")
    if masked(zlib.crc32(payload)) != struct.unpack_from("<I", record, 12 + size)[0]:
        raise ValueError("a record's payload is damaged")
    return payload


def pack_ids(ids: np.ndarray) -> bytes:
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    return bytes([width]) + ids.astype(f"<u{width}").tobytes()


def unpack_ids(payload: bytes) -> np.ndarray:
    return np.frombuffer(payload, dtype=f"<u{payload[0]}", offset=1).astype(np.uint32)


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write_records(
    docs: DataFrame, tokenizer: str, end_id: int, root: str | None = None, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write every document's ids, in ascending id order over the numbered parts, and return the index.

    A null text is empty: its record holds the end id alone. Null ids come first; rows
    with one id are ordered by their text's hash, so a much repeated id spreads over
    parts. An empty table writes no record. `root` must be a folder that all executors
    share (default: below the checkpoint folder). Other columns are not read.
    """
    spark = docs.sparkSession
    root = root or scratch_path(spark, "records")
    if "://" not in root and root.startswith("file:"):
        root = "file://" + root[5:]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        store, folder = _open(root)
        name, coder, out, at, start = f"part-{part:06d}-{uuid.uuid4().hex}.rec", None, None, 0, 0
        try:
            for batch in batches:
                for piece in slices(batch, "text", SLICE_BYTES):
                    if out is None:
                        store.create_dir(folder, recursive=True)
                        out, coder = store.open_output_stream(f"{folder}/{name}"), encoder(tokenizer)
                    ids, bounds = coder.encode(piece.column("text"))
                    rows = []
                    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                        own = np.append(ids[low:high], np.uint32(end_id))
                        record = frame(pack_ids(own))
                        out.write(record)
                        rows.append((at, len(record), start, len(own)))
                        at, start = at + len(record), start + len(own)
                    n, found = len(rows), np.array(rows, dtype=np.int64).reshape(-1, 4)
                    columns = [piece.column("doc_id"), pa.array([name] * n, pa.string()), pa.array([part] * n, pa.int32())]
                    columns += [pa.array(found[:, k]) for k in range(4)]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "file", "part", "at", "size", "start", "n_tokens"])
        finally:
            if out is not None:
                out.close()

    ordered = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    index = materialize(ordered.mapInArrow(write, INDEX), "index")
    # One row per part; the sums before a part turn its own starts into global ones.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = index.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = materialize(
        parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("part_start")), "parts"
    )
    return (
        index.join(parts, "part")
        .withColumn("start", F.col("start") + F.col("part_start"))
        .withColumn("file", F.concat(F.lit(f"{root}/"), F.col("file")))
        .drop("part_start")
    )


def read_records(index: DataFrame) -> DataFrame:
    """Read the records that an index (or any part of it, in any order) names.

    Returns doc_id, start, n_tokens and ids_crc32, all from the files. Every length
    and checksum is verified; a damaged or missing record is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        uri, source = None, None
        for batch in batches:
            counts, crcs = [], []
            for file, at, size in zip(*(batch.column(c).to_pylist() for c in ("file", "at", "size"))):
                if file != uri:
                    if source is not None:
                        source.close()
                    store, path = _open(file)
                    uri, source = file, store.open_input_file(path)
                ids = unpack_ids(unframe(source.read_at(size, at)))
                counts.append(len(ids))
                crcs.append(zlib.crc32(ids.astype("<u4").tobytes()))
            columns = [batch.column("doc_id"), batch.column("start"), pa.array(counts, pa.int64()), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])
        if source is not None:
            source.close()

    return index.select("doc_id", "file", "at", "size", "start").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
