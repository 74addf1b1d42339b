"""Self-join of texts on the Jaccard similarity of their word n-grams.

Texts with equal n-gram sets are one class and are compared once. Each class gets a
MinHash signature, cut into bands whose number and size are chosen for the target
recall. Classes that share a band are candidates: every bucket links its members to
its smallest one, never to each other. What hangs together is compared on full
n-gram sets, small blocks against small blocks, so that a large group of near copies
spreads over many tasks; a task returns counts and a spanning forest, not pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfsight.llm import arrays
from shelfsight.llm.common import bloom, in_bloom, without
from shelfsight.llm.components import components
from shelfsight.sources.scratch import materialize

WORDS, SIMILARITY, RECALL = 5, 0.8, 0.9999
#: Hash functions at most, classes and n-grams in one block of a comparison, and n-grams compared at once.
MOST_HASHES, BLOCK_CLASSES, BLOCK_GRAMS, COLUMNS = 128, 256, 1 << 19, 1 << 13


def choose_bands(similarity: float = SIMILARITY, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most selective ones that find `recall` of the pairs at `similarity`."""
    for rows in range(most, 0, -1):
        miss = 1 - similarity**rows
        bands = math.ceil(math.log(1 - recall) / math.log(miss)) if miss > 0 else 1
        if bands * rows <= most:
            return bands, rows
    raise ValueError("too few hash functions for this recall")


def shingles(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of each text, ascending within it, and where each text's start.

    A-Z are lowered. A text of fewer than `n` words has one n-gram, all its words; a
    text without words has none.
    """
    data = arrays.LOWER[data]
    starts, ends, rows = arrays.word_spans(data, offsets)
    words = arrays.span_hashes(data, starts, ends)
    grams, first = arrays.gram_hashes(words, rows, n)
    owner = rows[first]
    bounds = arrays.firsts(rows, len(offsets) - 1)
    for k in range(1, n):
        short = np.flatnonzero(np.diff(bounds) == k)
        if len(short):
            total = np.full(len(short), k, dtype=np.uint64)
            for j in range(k):
                total = arrays.mix(total + words[bounds[short] + j])
            grams, owner = np.concatenate([grams, total]), np.concatenate([owner, short])
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    grams, owner = grams[new], owner[new]
    return grams, np.searchsorted(owner, np.arange(len(offsets)))


def band_keys(grams: np.ndarray, bounds: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A key per text (with n-grams) and band, from `bands * rows` MinHash values."""
    full = np.flatnonzero(np.diff(bounds))
    heads = bounds[:-1][full]
    random = np.random.Generator(np.random.PCG64(77))
    factors = random.integers(1, 2**63, (bands, rows), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = random.integers(0, 2**63, (bands, rows), dtype=np.uint64)
    out = np.zeros((len(full), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(full), b + 1, dtype=np.uint64)
        for r in range(rows):
            low = np.minimum.reduceat(grams * factors[b, r] + shifts[b, r], heads) if len(full) else heads.astype(np.uint64)
            key = arrays.mix(key * factors[b, r] + low)
        out[:, b] = key
    return out


def _signs(grams: np.ndarray, bounds: np.ndarray) -> list[bytes | None]:
    raw = memoryview(grams.tobytes())
    return [
        hashlib.blake2b(raw[8 * a : 8 * b], digest_size=16).digest() if b > a else None
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())
    ]


def _as_long(sign: bytes) -> int:
    return int.from_bytes(sign[:8], "big", signed=True)


def compare_block(group: pa.Table, similarity: float) -> pa.Table:
    """Links among the classes of one block, or between the classes of two, with a forest of them.

    What hangs together within a block hangs on one root there. Only the task of the
    block itself returns these edges; a task of two blocks links roots to roots, so its
    edges do not grow with the classes that a root stands for.
    """
    signs = group.column("sign").to_pylist()
    copies, block = group.column("copies").to_numpy(), group.column("block").to_numpy()
    sets = [np.frombuffer(s, dtype=np.uint64) for s in group.column("grams").to_pylist()]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only n-grams of two classes or more can add to an overlap.
    number = np.cumsum(times > 1) - 1
    useful = times[column] > 1
    column, owner = number[column[useful]], owner[useful]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        part[owner[a:b], column[a:b] - low] = 1
        both += part @ part.T
    union = sizes[:, None] + sizes[None, :] - both
    linked = both >= similarity * union - 1e-9
    np.fill_diagonal(linked, False)
    cross = group.column("i")[0].as_py() != group.column("j")[0].as_py()
    same_block = block[:, None] == block[None, :]
    root = list(range(len(sets)))

    def top(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    def join(pairs: np.ndarray):
        for a, b in zip(*np.nonzero(np.triu(pairs))):
            x, y = top(int(a)), top(int(b))
            if signs[x] > signs[y]:
                x, y = y, x
            root[y] = x

    join(linked & same_block)
    if cross:
        inside = [top(k) for k in range(len(sets))]
        linked &= ~same_block
        join(linked)
        root = [top(k) if inside[k] == k else k for k in range(len(sets))]
    return pa.table(
        {
            "sign": pa.array(signs, pa.binary()),
            "root": pa.array([signs[top(k)] for k in range(len(sets))], pa.binary()),
            "links": pa.array(linked.sum(axis=1).astype(np.int64)),
            "linked_docs": pa.array((linked * copies[None, :]).sum(axis=1).astype(np.int64)),
        }
    )


def near_classes(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    words: int = WORDS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of `docs`: doc_id, class_id, copy_id, copies, n_links, n_text_links, text_key.

    `class_id` is the smallest id of all rows that links connect; `copy_id` the smallest
    id of the rows with the same n-gram set, `copies` their number; `n_links` how many
    other rows have a similarity of at least `similarity`, `n_text_links` how many other
    n-gram sets have. Words are compared with A-Z lowered. A row without words (a null
    text, too) is linked to none and is its own class. Null ids never name a class that
    has another id. Repeated rows are copies. An empty table gives no rows. `text_key`
    is a hash that tells rows with one id apart. Starts Spark jobs.
    """
    bands, rows = choose_bands(similarity, recall)
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in arrays.slices(batch, "text"):
                grams, bounds = shingles(*arrays.buffers(piece.column("text")), words)
                signs, keys = _signs(grams, bounds), iter(arrays.signed(band_keys(grams, bounds, bands, rows)).tolist())
                columns = [piece.column("doc_id"), piece.column("text_key"), pa.array(signs, pa.binary()), pa.array(np.diff(bounds))]
                columns.append(pa.array([next(keys) if s else None for s in signs], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "sign", "n_grams", "bands"])

    signed = materialize(
        docs.withColumn("text_key", F.xxhash64("text"))
        .mapInArrow(sign, "doc_id long, text_key long, sign binary, n_grams long, bands array<long>"),
        "signed",
    )
    classes = materialize(
        signed.filter("sign is not null")
        .groupBy("sign")
        .agg(
            F.min("doc_id").alias("copy_id"),
            F.count(F.lit(1)).alias("copies"),
            F.max("n_grams").alias("n_grams"),
            F.any_value("bands").alias("bands"),
        ),
        "classes",
    )
    keyed = classes.select("sign", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("sign").alias("hub")).filter("n > 1")
    stars = keyed.join(buckets.select("key", "hub"), "key").filter("sign <> hub").select(F.col("sign").alias("a"), F.col("hub").alias("b"))
    candidates = components(materialize(stars.distinct(), "stars"))

    # Blocks by hash, so that no group is ordered or counted in one task.
    nodes = materialize(candidates.withColumnRenamed("node", "sign").join(classes.drop("bands", "copy_id"), "sign"), "nodes")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_CLASSES, F.sum("n_grams") / BLOCK_GRAMS)).cast("int")
    members = nodes.join(nodes.groupBy("label").agg(blocks.alias("blocks")), "label")
    members = members.withColumn("block", F.pmod(F.xxhash64("sign"), F.col("blocks")).cast("int"))
    members = materialize(members.drop("n_grams"), "members")
    first_half = F.conv(F.hex(F.substring("sign", 1, 8)), 16, -10).cast("long").alias("half")
    wanted = bloom(members.select(first_half), "half")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            for piece in arrays.slices(batch, "text"):
                grams, bounds = shingles(*arrays.buffers(piece.column("text")), words)
                signs = _signs(grams, bounds)
                halves = np.array([_as_long(s) if s else 0 for s in signs], dtype=np.int64)
                out = {}
                for k in np.flatnonzero(in_bloom(wanted.value, halves)).tolist():
                    if signs[k] and signs[k] not in seen:
                        out[signs[k]] = grams[bounds[k] : bounds[k + 1]].tobytes()
                        if len(seen) < 1 << 16:  # copies beyond that are sent again, and dropped below
                            seen.add(signs[k])
                columns = [pa.array(out.keys(), pa.binary()), pa.array(out.values(), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["sign", "grams"])

    sets = docs.select("text").mapInArrow(gather, "sign binary, grams binary").dropDuplicates(["sign"])
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = (
        members.join(sets, "sign")
        .select("sign", "label", "copies", "block", "grams", other)
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
        .drop("other")
    )
    found = materialize(
        tasks.groupBy("label", "i", "j").applyInArrow(
            lambda group: compare_block(group, similarity), "sign binary, root binary, links long, linked_docs long"
        ),
        "links",
    )
    joined = components(found.filter("sign <> root").select(F.col("sign").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("sign").agg(F.sum("links").alias("links"), F.sum("linked_docs").alias("linked_docs"))
    named = classes.drop("bands", "n_grams").join(joined.withColumnRenamed("node", "sign"), "sign", "left")
    named = named.withColumn("label", F.coalesce("label", "sign"))
    names = named.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    info = materialize(
        named.join(names, "label")
        .join(counts, "sign", "left")
        .select(
            "sign", "class_id", "copy_id", "copies",
            (F.col("copies") - 1 + F.coalesce("linked_docs", F.lit(0))).alias("n_links"),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_text_links"),
        ),
        "named",
    )
    columns = ("doc_id", "class_id", "copy_id", "copies", "n_links", "n_text_links", "text_key")
    alone = signed.filter("sign is null").withColumns(
        {
            "class_id": F.col("doc_id"), "copy_id": F.col("doc_id"), "copies": F.lit(1).cast("long"),
            "n_links": F.lit(0).cast("long"), "n_text_links": F.lit(0).cast("long"),
        }
    )
    return signed.drop("bands", "n_grams").join(info, "sign").select(*columns).unionByName(alone.select(*columns))


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """The rows of `docs` whose id names their class, with all their columns.

    Of rows that repeat that id in one class, one stays. Rows without an id stay.
    """
    found = near_classes(docs, id_column=id_column, text_column=text_column, **settings)
    key = [F.col("doc_id").alias("_id"), F.col("text_key").alias("_text")]
    decided = materialize(
        found.filter("doc_id is not null and (doc_id <> class_id or copies > 1)").select(*key, (F.col("doc_id") == F.col("class_id")).alias("_kept")),
        "decided",
    )
    same = (F.col(id_column) == F.col("_id")) & (F.col("_key") == F.col("_text"))
    keyed = docs.withColumn("_key", F.xxhash64(text_column))
    dropped = decided.filter("not _kept").select("_id", "_text").distinct()
    chosen = without(keyed, dropped, same, F.xxhash64(F.col(id_column).cast("long"), "_key"), F.xxhash64("_id", "_text"))
    repeats = decided.filter("_kept").groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("_id")
    if repeats.isEmpty():
        return chosen.drop("_key")
    again = F.col(id_column) == F.col("_id")
    once = chosen.join(repeats, again, "left_semi").dropDuplicates([id_column])
    return chosen.join(repeats, again, "left_anti").unionByName(once).drop("_key")
