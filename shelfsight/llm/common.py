"""Small shared parts: inputs, exact binomial tails, a filter of fixed size."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "[^\\x20\\x09-\\x0D]+"
UPPER, LOWERED = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of a Bloom filter: 1 MiB on the driver and in each Python worker, whatever the input.
BLOOM_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """The place of a public tokenizer's vocabulary file on this machine and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def lowered(text: Column) -> Column:
    """The text with A-Z lowered and nothing else changed; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWERED)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial(n, p), summed exactly in log space."""
    if k >= n:
        return 1.0
    if p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    terms = [
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
        for i in range(k + 1)
    ]
    top = max(terms)
    return min(1.0, math.exp(top) * math.fsum(math.exp(t - top) for t in terms))


def bloom(keys: DataFrame, column: str, bits: int = BLOOM_BITS) -> Broadcast:
    """Broadcast a filter of exactly `bits` bits that holds every value of a long column.

    Spark combines the bits into at most `bits / 64` words before any reach the
    driver, so the size is fixed. A full filter only lets more rows through; what
    passes is always checked exactly afterwards.
    """
    key = F.col(column)
    places = F.explode(F.array(*[F.pmod(x, F.lit(bits)) for x in (key, F.shiftrightunsigned(key, 32))])).alias("bit")
    words = (
        keys.select(places)
        .groupBy((F.col("bit") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
        .toArrow()
    )
    found = np.zeros(bits // 64, dtype=np.int64)
    found[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return keys.sparkSession.sparkContext.broadcast(found.view(np.uint64))


def in_bloom(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which signed 64-bit keys may be in the filter."""
    bits = np.int64(len(words) * 64)
    out = np.ones(len(keys), dtype=bool)
    high = (keys.view(np.uint64) >> np.uint64(32)).view(np.int64)
    for place in (np.mod(keys, bits), np.mod(high, bits)):
        out &= (words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
    return out


def without(docs: DataFrame, dropped: DataFrame, same: Column, key: Column, dropped_key: Column) -> DataFrame:
    """The rows of `docs` that no row of `dropped` matches.

    Equal rows have equal keys. A filter of fixed size lets the rows through that may
    match; only they are shuffled and joined, the others never move.
    """
    held = bloom(dropped.select(dropped_key.alias("_hash")).distinct(), "_hash")
    schema = docs.schema
    names = docs.columns

    def part(batches, wanted: bool):
        for batch in batches:
            maybe = in_bloom(held.value, batch.column("_hash").to_numpy())
            yield batch.select(names).filter(pa.array(maybe == wanted))

    hashed = docs.withColumn("_hash", key)
    suspects = hashed.mapInArrow(lambda b: part(b, True), schema)
    return hashed.mapInArrow(lambda b: part(b, False), schema).unionByName(suspects.join(dropped, same, "left_anti"))
