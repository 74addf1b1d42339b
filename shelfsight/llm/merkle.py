"""Merkle manifest of a dataset as a postorder append log.

Every tree has runs of eight children. Aligned builders take 512 neighbouring nodes
each (three levels) and append what they complete, a parent right after its last
child, so a subtree is one contiguous stretch of its tree's log. The place of any
node follows in closed form from the sizes of the subtrees before it: proofs address
siblings by place, and no node needs to know its neighbours. Leaves are hashed by
Spark's own functions; texts are never shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfsight.llm.common import LOWERED, UPPER
from shelfsight.sources.scratch import materialize

ARITY, BUILDER_LEVELS = 8, 3
BLOCK = ARITY**BUILDER_LEVELS
LOG = "tree long, position long, level int, block long, digest binary"


def height(leaves: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while leaves > 1:
        leaves, levels = -(-leaves // ARITY), levels + 1
    return levels


def position(level: int, index: np.ndarray | int, leaves: int) -> np.ndarray | int:
    """The place in the postorder log of node `index` of `level` in a tree of `leaves` leaves.

    Before it lie the leaves up to its last one, the nodes that were complete by then
    (one per full run on each level) and, where the tree's end cuts it short, the short
    nodes of lower levels.
    """
    last = np.minimum((index + 1) * ARITY**level, leaves)
    before = last - 1
    short = np.zeros_like(last)
    for k in range(1, height(leaves) + 1):
        size = ARITY**k
        # A run that ends exactly here is this node or one of its descendants, up to its own level.
        closed = last // size if k <= level else (last - 1) // size
        before = before + closed
        if k <= level:
            short = short + (last % size != 0)
    return before + short


def parent(digests: list[bytes]) -> bytes:
    """SHA-256 of the children's digests as lower-case hex text."""
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


def built(first: int, level: int, digests: list[bytes], leaves: int) -> Iterator[tuple[int, int, bytes]]:
    """What one builder appends: (level, place, digest) of the nodes above `digests`, in completion order.

    `digests` are the nodes of `level` from index `first` on, one aligned block of them.
    """
    top = min(level + BUILDER_LEVELS, height(leaves))
    open_runs: list[list[bytes]] = [[] for _ in range(top - level + 1)]
    done = [first // ARITY**k for k in range(top - level + 1)]

    def complete(k: int) -> tuple[int, int, bytes]:
        digest = parent(open_runs[k - 1])
        open_runs[k - 1].clear()
        if k < len(open_runs):
            open_runs[k].append(digest)
        at = int(position(level + k, np.int64(done[k]), leaves))
        done[k] += 1
        return level + k, at, digest

    for digest in digests:
        open_runs[0].append(digest)
        for k in range(1, top - level + 1):
            if len(open_runs[k - 1]) < ARITY:
                break
            yield complete(k)
    for k in range(1, top - level + 1):
        if open_runs[k - 1]:
            yield complete(k)


def _builder(level: int):
    """The work of the builders whose inputs are nodes of `level`; leaves are appended with what they complete."""

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("index")
        tree, leaves, first = (group.column(c)[0].as_py() for c in ("tree", "leaves", "index"))
        digests = group.column("digest").to_pylist()
        own = position(0, first + np.arange(len(digests)), leaves).tolist() if level == 0 else []
        rows = sorted([(at, 0, d) for at, d in zip(own, digests)] + [(at, k, d) for k, at, d in built(first, level, digests, leaves)])
        columns = {
            "tree": pa.array([tree] * len(rows), pa.int64()),
            "position": pa.array([r[0] for r in rows], pa.int64()),
            "level": pa.array([r[1] for r in rows], pa.int32()),
            "block": pa.array([first // BLOCK] * len(rows), pa.int64()),
            "digest": pa.array([r[2] for r in rows], pa.binary()),
            "leaves": pa.array([leaves] * len(rows), pa.int64()),
        }
        return pa.table(columns)

    return build


def write_log(nodes: DataFrame) -> DataFrame:
    """Append all nodes of the trees to a log and return it: tree, position, level, block, digest.

    `nodes` holds the leaves: tree, leaf (0-based index), digest, leaves (of the tree).
    Builders work tier by tier, each tier on the top nodes of the one below; `block` is
    the builder's number within its tier. Starts Spark jobs.
    """
    most = nodes.agg(F.max("leaves")).first()[0] or 0
    level, tiers = 0, []
    below = nodes.select("tree", F.col("leaf").alias("index"), "leaves", "digest")
    while True:
        block = F.floor(F.col("index") / BLOCK)
        log = materialize(below.groupBy("tree", block.alias("block")).applyInArrow(_builder(level), f"{LOG}, leaves long"), "log")
        tiers.append(log)
        level += BUILDER_LEVELS
        if ARITY**level >= most:
            break
        # A block's top node has its builder's number; smaller trees end below this level.
        below = log.filter((F.col("level") == level) & (F.col("leaves") > ARITY**level))
        below = below.select("tree", F.col("block").alias("index"), "leaves", "digest")
    out = tiers[0]
    for tier in tiers[1:]:
        out = out.unionByName(tier)
    return out.drop("leaves")


def siblings(index: int, level: int, leaves: int) -> list[tuple[int, int]]:
    """(place, slot) of the other nodes of the run that node `index` of `level` belongs to."""
    nodes = -(-leaves // ARITY**level)
    low = index // ARITY * ARITY
    others = [k for k in range(low, min(low + ARITY, nodes)) if k != index]
    return [(int(position(level, np.int64(k), leaves)), k - low) for k in others]


def above(starts: DataFrame, from_level: int) -> DataFrame:
    """The places of all siblings on the way up from a node of `from_level`: tree, key, position, level, slot.

    `starts` holds tree, key, index (of the node) and leaves. At most seven rows per level.
    """

    def climb(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, key, index, leaves in zip(*(batch.column(c).to_pylist() for c in ("tree", "key", "index", "leaves"))):
                for level in range(from_level, height(leaves)):
                    rows += [(tree, key, at, level, slot) for at, slot in siblings(index, level, leaves)]
                    index //= ARITY
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32())
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["tree", "key", "position", "level", "slot"]
            )

    return starts.mapInArrow(climb, "tree long, key long, position long, level int, slot int")


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 length, a colon and its value, or `-` where it is null."""
    parts = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in fields]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def numbered(rows: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Add `leaf`, the 0-based position within `by`, and `leaves`, the rows of it.

    Range slices are numbered on their own and the sizes of earlier slices are added, so
    a large group spreads over many tasks. The result reads a written table.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen, last = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            group = batch.column(by).to_numpy()
            if not len(group):
                continue
            place = np.arange(len(group))
            begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            place -= np.repeat(begins, np.diff(np.append(begins, len(group))))
            if last == group[0]:
                place[: begins[1] if len(begins) > 1 else len(group)] += seen
            seen, last = int(place[-1]) + 1, group[-1]
            columns = [*batch.columns, pa.array(np.full(len(group), cut)), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "slice", "place"])

    schema = rows.schema.simpleString()[7:-1].replace(":", " ").replace(",", ", ") + ", slice long, place long"
    ranged = rows.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    sliced = materialize(ranged.mapInArrow(number, schema), "slices")
    counts = sliced.groupBy(by, "slice").agg(F.count(F.lit(1)).alias("n"))
    # At most one row per slice and group.
    before = Window.partitionBy(by).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(by)
    offsets = counts.select(
        by, "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"), F.sum("n").over(whole).alias("leaves")
    )
    joined = sliced.join(materialize(offsets, "offsets"), [by, "slice"])
    return joined.withColumn("leaf", F.col("place") + F.col("offset")).drop("slice", "place", "offset")


def manifest(docs: DataFrame) -> DataFrame:
    """Return doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of `docs`.

    Reads doc_id, source, lang, n_chars and text. Within a lang, leaves ascend by doc_id (null
    first; rows with one id by their digest, so repeated rows are leaves of their own); langs
    by their UTF-8 bytes, null first. A run of one node is hashed, too. A lone leaf is its
    own subroot, a lone subroot the root, and its proof the hash of nothing. Rows whose id's
    CRC-32 is divisible by three (a null id has none) are verified with the text's A-Z
    lowered, all others as they are. An empty table gives no rows. Starts Spark jobs.
    """
    as_text = [F.col("doc_id").cast("string"), F.col("source"), F.col("lang"), F.col("n_chars").cast("string")]
    tampered = F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0)
    text = F.col("text")
    hashed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "lang",
        leaf_digest([*as_text, text]).alias("digest"),
        F.when(tampered, leaf_digest([*as_text, F.translate(text, UPPER, LOWERED)])).alias("changed"),
    )
    hashed = materialize(hashed, "leaves")
    # One row per lang: its number is the place of its tree among all trees.
    langs = hashed.select("lang").distinct().withColumn("group", F.lit(0).cast("long"))
    langs = langs.withColumn("bytes", F.col("lang").cast("binary"))
    langs = numbered(langs.select("group", "bytes"), "group", ["bytes"])
    langs = materialize(langs.select("bytes", F.col("leaf").alias("tree"), F.col("leaves").alias("trees")), "langs")
    same = F.col("lang").cast("binary").eqNullSafe(F.col("bytes"))
    rows = hashed.join(langs, same).select("tree", "trees", "doc_id", "digest", "changed")
    rows = materialize(numbered(rows, "tree", ["doc_id", "digest"]), "numbered")
    log = write_log(rows)

    sizes = materialize(rows.groupBy("tree").agg(F.max("leaves").alias("leaves")), "sizes")
    # The last node of each log is its tree's root.
    roots = log.groupBy("tree").agg(F.max_by("digest", "position").alias("subroot"))
    roots = materialize(roots.join(langs.select("tree", "trees"), "tree"), "roots")
    tops = roots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("leaf"), F.col("subroot").alias("digest"), F.col("trees").alias("leaves")
    )
    top_log = write_log(tops)
    root = top_log.agg(F.max_by("digest", "position")).first()[0] or b""

    blocks = F.floor((F.col("leaves") + BLOCK - 1) / BLOCK)
    starts = sizes.withColumn("key", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    starts = starts.select("tree", "key", F.col("key").alias("index"), "leaves")
    lower = above(starts, BUILDER_LEVELS).join(log.drop("level", "block"), ["tree", "position"])
    lower = lower.select("tree", F.col("key").alias("block"), F.lit(1).alias("stage"), "level", "slot", "digest")
    upper = above(tops.select("tree", F.col("leaf").alias("key"), F.col("leaf").alias("index"), "leaves"), 0)
    upper = upper.join(top_log.drop("level", "block"), ["tree", "position"])
    upper = upper.select(F.col("key").alias("tree"), F.lit(2).alias("stage"), "level", "slot", "digest")
    upper = starts.select("tree", F.col("key").alias("block")).join(materialize(upper, "upper"), "tree")
    own = log.filter(F.col("level") <= BUILDER_LEVELS).select(
        "tree", "block", F.lit(0).alias("stage"), "level", F.col("position").alias("slot"), "digest"
    )
    named = ("tree", "block", "stage", "level", "slot", "digest")
    path = own.unionByName(lower).unionByName(upper.select(*named))
    leaves = rows.withColumn("block", F.floor(F.col("leaf") / BLOCK)).select(
        "tree", "trees", "block", "leaf", "leaves", "doc_id", "digest", "changed"
    )

    proofs = leaves.groupBy("tree", "block").cogroup(path.groupBy("tree", "block")).applyInArrow(
        prove, "tree long, doc_id long, leaf string, proof_sha256 string, folded_root string"
    )
    known = roots.select("tree", F.lower(F.hex("subroot")).alias("subroot"), F.lit(root.hex()).alias("root"))
    return proofs.join(known, "tree").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )


def prove(leaves: pa.Table, path: pa.Table) -> pa.Table:
    """Proof and fold of the leaves of one block, from its stretch of the log and its way up."""
    leaves = leaves.sort_by("leaf")
    tree, block, n, trees = (leaves.column(c)[0].as_py() for c in ("tree", "block", "leaves", "trees"))
    stretch, ways = {}, {}
    for stage, level, slot, digest in zip(*(path.column(c).to_pylist() for c in ("stage", "level", "slot", "digest"))):
        if stage:
            ways.setdefault((stage, level), []).append((slot, digest.hex().encode()))
        else:
            stretch[slot] = digest.hex().encode()
    inner, first = min(BUILDER_LEVELS, height(n)), block * BLOCK
    inside = []
    for level in range(inner):
        low = first // ARITY**level
        high = min(low + BLOCK // ARITY**level, -(-n // ARITY**level))
        inside.append([stretch[at] for at in position(level, np.arange(low, high), n).tolist()])
    # The way up is the same for the whole block: what lies left and right of it, level by level.
    climbs = [(1, level, block // ARITY ** (level - BUILDER_LEVELS)) for level in range(inner, height(n))]
    climbs += [(2, level, tree // ARITY**level) for level in range(height(trees))]
    sides = []
    for stage, level, index in climbs:
        found, slot = sorted(ways.get((stage, level), [])), index % ARITY
        sides.append((b"".join(d for k, d in found if k < slot), b"".join(d for k, d in found if k > slot)))
    shared = b"".join(left + right for left, right in sides)

    out = {"leaf": [], "proof_sha256": [], "folded_root": []}
    for leaf, digest, changed in zip(*(leaves.column(c).to_pylist() for c in ("leaf", "digest", "changed"))):
        index, proof, node = leaf - first, [], (changed or digest).hex().encode()
        for nodes in inside:
            low, slot = index // ARITY * ARITY, index % ARITY
            left, right = b"".join(nodes[low : low + slot]), b"".join(nodes[low + slot + 1 : low + ARITY])
            proof += [left, right]
            node = hashlib.sha256(left + node + right).hexdigest().encode()
            index //= ARITY
        for left, right in sides:
            node = hashlib.sha256(left + node + right).hexdigest().encode()
        out["leaf"].append(digest.hex())
        out["proof_sha256"].append(hashlib.sha256(b"".join(proof) + shared).hexdigest())
        out["folded_root"].append(node.decode())
    columns = {"tree": leaves.column("tree"), "doc_id": leaves.column("doc_id")}
    return pa.table(columns | {c: pa.array(v, pa.string()) for c, v in out.items()})
