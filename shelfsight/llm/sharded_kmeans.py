"""Centroid clustering by a dimension-sharded Lloyd iteration on whole numbers.

Vectors are cut into column blocks. A task that holds one column block of some rows
needs only the matching slice of the centroids: it computes the exact partial squared
distances of its rows to all of them. Partials are added by row block, which gives the
nearest centroid; then each shard sums its own columns per cluster and updates its own
slice. No task holds a whole vector beside whole centroids, and no vector is shuffled,
only partial distances and cluster numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.golomb import pack_numbers, unpack_numbers
from shelfsight.sources.scratch import materialize

CLUSTERS, ROUNDS, SHARDS, SCALE = 16, 3, 4, 64
#: Vectors in one row block; a partial result has this many rows and a column per centroid.
BLOCK_ROWS = 1 << 11
#: Components are held to this size, so that no distance leaves 64 bits.
LARGEST = 1 << 27
SHARD = "block long, shard int, n int, low long, packed binary"


def whole_numbers(vectors: Column, dims: int) -> Column:
    """floor(SCALE * x) of each component; null unless there are `dims`, none of them null or non-finite."""
    fine = (F.size(vectors) == dims) & F.forall(
        vectors, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))
    )
    limit = F.lit(float(LARGEST))
    whole = F.transform(vectors, lambda x: F.floor(F.greatest(F.least(x.cast("double") * SCALE, limit), -limit)).cast("long"))
    return F.when(fine, whole)


def shard_rows(rows: DataFrame, dims: int, shards: int, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """The column blocks (block, shard, n, low, packed) and the ids (block, ids) of all row blocks.

    `rows` holds vec_id and whole (an array of longs). A column block is packed as its
    least value and the differences from it. Ids travel as shard -1.
    """
    bounds = [dims * s // shards for s in range(shards + 1)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, []

        def flush(part: pa.Table, block: int) -> pa.RecordBatch:
            values = pc.list_flatten(part.column("whole").combine_chunks()).to_numpy().reshape(part.num_rows, dims)
            pieces = [values[:, a:b].ravel() for a, b in zip(bounds[:-1], bounds[1:])]
            ids = part.column("vec_id").combine_chunks()
            lows = [int(p.min()) if len(p) else 0 for p in pieces]
            packed = [pack_numbers(p - low) for p, low in zip(pieces, lows)]
            n = shards + 1
            columns = [
                pa.array([block] * n), pa.array([*range(shards), -1], pa.int32()), pa.array([part.num_rows] * n, pa.int32()),
                pa.array([*lows, 0], pa.int64()), pa.array([*packed, b""], pa.binary()),
                pa.array([None] * shards + [ids.to_pylist()], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, names=["block", "shard", "n", "low", "packed", "ids"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= block_rows:
                whole = pa.Table.from_batches(held)
                yield flush(whole.slice(0, block_rows), block)
                block, held = block + 1, whole.slice(block_rows).to_batches()
        if sum(b.num_rows for b in held):
            yield flush(pa.Table.from_batches(held), block)

    both = materialize(rows.select("vec_id", "whole").mapInArrow(cut, f"{SHARD}, ids array<long>"), "columns")
    return both.filter("shard >= 0").drop("ids"), both.filter("shard < 0").select("block", "ids")


def slice_of(numbers: list[int], clusters: list[int], dims: list[int], k: int) -> np.ndarray:
    """The centroid slice of one shard as a matrix, a row per cluster."""
    low = min(dims)
    out = np.zeros((k, max(dims) - low + 1), dtype=np.int64)
    out[clusters, np.array(dims) - low] = numbers
    return out


def nearest(columns: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    """Return block, cluster and distance (packed numbers), a row per row block.

    Each column block adds its partial squared distances to every centroid; equal
    distances go to the smaller cluster.
    """
    slices = centroids.groupBy("shard").agg(
        F.collect_list(F.struct("cluster", "dim", "value")).alias("slice")  # at most k x dims numbers
    )

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for n, low, packed, cells in zip(*(batch.column(c).to_pylist() for c in ("n", "low", "packed", "slice"))):
                centre = slice_of(*zip(*((x["value"], x["cluster"], x["dim"]) for x in cells)), k) if cells else np.zeros((k, 0))
                values = (unpack_numbers(packed) + low).reshape(n, -1)
                out.append(pack_numbers(np.stack([((values - c) ** 2).sum(axis=1) for c in centre], axis=1).ravel()))
            columns = [batch.column("block"), batch.column("n"), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["block", "n", "partial"])

    def add(group: pa.Table) -> pa.Table:
        n = group.column("n")[0].as_py()
        total = np.zeros((n, k), dtype=np.int64)
        for part in group.column("partial").to_pylist():
            total += unpack_numbers(part).reshape(n, k)
        cluster = total.argmin(axis=1)
        found = {"block": group.column("block")[0].as_py(), "cluster": pack_numbers(cluster), "distance": pack_numbers(total.min(axis=1))}
        kinds = {"block": pa.int64(), "cluster": pa.binary(), "distance": pa.binary()}
        return pa.table({c: pa.array([v], kinds[c]) for c, v in found.items()})

    partials = columns.join(slices, "shard").select("block", "n", "low", "packed", "slice")
    partials = partials.mapInArrow(partial, "block long, n int, partial binary")
    return materialize(partials.groupBy("block").applyInArrow(add, "block long, cluster binary, distance binary"), "nearest")


def updated(columns: DataFrame, assigned: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    """The centroids with each non-empty cluster's value as floor(sum / count); empty ones stay.

    Column blocks are summed per cluster within each task, so what is shuffled is at
    most k x dims numbers a task.
    """
    width = centroids.groupBy("shard").agg(F.min("dim").alias("first"))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        count: dict[int, np.ndarray] = {}
        names = ("shard", "first", "n", "low", "packed", "cluster")
        for batch in batches:
            for shard, first, n, low, packed, cluster in zip(*(batch.column(c).to_pylist() for c in names)):
                values, own = (unpack_numbers(packed) + low).reshape(n, -1), unpack_numbers(cluster)
                key = (shard, first)
                if key not in total:
                    total[key], count[key] = np.zeros((k, values.shape[1]), dtype=np.int64), np.zeros(k, dtype=np.int64)
                order = np.argsort(own, kind="stable")
                begins = np.flatnonzero(np.diff(own[order], prepend=-1))
                total[key][own[order][begins]] += np.add.reduceat(values[order], begins, axis=0)
                count[key] += np.bincount(own, minlength=k)
        for (shard, first), found in total.items():
            clusters, places = np.nonzero(np.ones_like(found))
            some = [np.full(found.size, shard, dtype=np.int32), clusters.astype(np.int32), (places + first).astype(np.int32)]
            some += [found.ravel(), count[shard, first][clusters]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in some], names=["shard", "cluster", "dim", "total", "n"])

    held = columns.join(assigned.select("block", "cluster"), "block").join(width, "shard")
    summed = held.select("shard", "first", "n", "low", "packed", "cluster").mapInArrow(
        sums, "shard int, cluster int, dim int, total long, n long"
    )
    means = summed.groupBy("shard", "cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).filter("n > 0")
    means = means.select("shard", "cluster", "dim", F.expr("(total - pmod(total, n)) div n").alias("mean"))
    keys = ["shard", "cluster", "dim"]
    return materialize(
        centroids.join(means, keys, "left").select(*keys, F.coalesce("mean", "value").alias("value")), "centroids"
    )


def clusters(
    vectors: DataFrame,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = 64,
    shards: int = SHARDS,
    seed: int = 1,
    block_rows: int = BLOCK_ROWS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Return vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for every kept vector.

    Kept are vectors with exactly `dims` components, none null or non-finite; others (null
    and empty ones, too) give no row. Components become floor(64 x), held to +-2^27. The
    `k` kept vectors with the smallest SHA-256 of `seed:vec_id` start as centroids (a null
    id counts as an empty text; rows with equal ids are ordered by their components); with
    fewer vectors there are fewer centroids. Equal distances go to the smaller number.
    Repeated rows are vectors of their own; an empty table gives no rows. Other columns
    are not read. Sums of distances are held to the largest long. Starts Spark jobs.
    """
    whole = whole_numbers(F.col(vector_column), dims)
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), whole.alias("whole")).filter("whole is not null")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = rows.orderBy(digest, "whole").limit(k).select("whole").collect()  # k vectors
    bounds = [dims * s // shards for s in range(shards + 1)]
    cells = [
        (s, c, d, row["whole"][d])
        for c, row in enumerate(first)
        for s in range(shards)
        for d in range(bounds[s], bounds[s + 1])
    ]
    spark, k = vectors.sparkSession, max(len(first), 1)
    centroids = materialize(spark.createDataFrame(cells, "shard int, cluster int, dim int, value long"), "centroids")
    columns, ids = shard_rows(rows, dims, shards, block_rows)
    for _ in range(rounds):
        centroids = updated(columns, nearest(columns, centroids, k), centroids, k)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, cluster, distance in zip(*(batch.column(c) for c in ("ids", "cluster", "distance"))):
                found = [own.values.cast(pa.int64()), pa.array(unpack_numbers(cluster.as_py()).astype(np.int32))]
                found.append(pa.array(unpack_numbers(distance.as_py())))
                yield pa.RecordBatch.from_arrays(found, names=["vec_id", "cluster", "distance"])

    final = ids.join(nearest(columns, centroids, k), "block").select("ids", "cluster", "distance")
    placed = materialize(final.mapInArrow(spread, "vec_id long, cluster int, distance long"), "placed")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    per = placed.groupBy("cluster").agg(wide.alias("wide"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda x: x["value"].cast("string")), ",")
    names = centroids.groupBy("cluster").agg(F.sha2(text, 256).alias("centroid_sha256"))
    per = materialize(per.join(names, "cluster"), "inertia")
    most = F.lit((1 << 63) - 1).cast("decimal(38,0)")
    inertia = F.lit(min(int(per.agg(F.sum("wide")).first()[0] or 0), (1 << 63) - 1)).cast("long")
    per = per.withColumn("cluster_inertia", F.least("wide", most).cast("long"))
    return placed.join(per, "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", inertia.alias("inertia"), "centroid_sha256"
    )
