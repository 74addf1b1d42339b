"""Reading and writing of landed payloads, training sets and snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfsight.operators.standardize import union_all

TEXT_PATTERN = "*.{csv,txt}"
PARQUET_PATTERN = "*.parquet"
SNAPSHOT_KINDS = ("csv", "json", "parquet")
# JSON text keeps microseconds only with an explicit format.
EXACT_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def land_payloads(payloads: DataFrame, root: str) -> None:
    """Append (asin, payload, _ingested_at) documents below root/site/kind as JSON lines."""
    writer = payloads.write.mode("append").partitionBy("site", "kind")
    writer.option("timestampFormat", EXACT_TIME).json(root)


def read_landed(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Landed documents of one kind; the partition filter prunes the folders read."""
    schema = "asin string, payload string, _ingested_at timestamp, site string, kind string"
    return spark.read.schema(schema).json(root).where(F.col("kind") == kind)


def recent_days(df: DataFrame, reference: dt.date, lookback: int) -> DataFrame:
    """Rows from `lookback` days before `reference` up to it; prunes `dt` partitions."""
    first = reference - dt.timedelta(days=lookback)
    return df.where(F.col("dt").between(F.lit(first), F.lit(reference)))


def ingest_window(timeseries: DataFrame, reviews: DataFrame, reference: dt.date) -> tuple[DataFrame, DataFrame]:
    """The increments of one ingest run: series of 2 days back, reviews of 7 days back."""
    since = F.col("dt") >= F.lit(reference - dt.timedelta(days=7))
    return recent_days(timeseries, reference, 2), reviews.where(since)


def load_dataset(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A file, or all .csv, .txt and .parquet files of a folder, as one table.

    Give `schema` for text files of any size; without it the types are inferred
    by an extra pass over the text. A path without such files is an error.
    """
    frames = []
    lower = path.lower()
    parquet = spark.read.option("pathGlobFilter", PARQUET_PATTERN)
    text = spark.read.option("header", True).option("pathGlobFilter", TEXT_PATTERN)
    text = text.schema(schema) if schema else text.option("inferSchema", True)
    if lower.endswith(".parquet"):
        return spark.read.parquet(path)
    if lower.endswith((".csv", ".txt")):
        return text.csv(path)
    # Asking for the file list reads no data, and tells which kinds are there.
    listing = spark.read.format("binaryFile")
    if not listing.option("pathGlobFilter", PARQUET_PATTERN).load(path).select("path").isEmpty():
        frames.append(parquet.option("mergeSchema", True).parquet(path))
    if not listing.option("pathGlobFilter", TEXT_PATTERN).load(path).select("path").isEmpty():
        frames.append(text.csv(path))
    if not frames:
        raise FileNotFoundError(f"no .csv, .txt or .parquet files in {path}")
    return union_all(frames)


def write_snapshot(df: DataFrame, root: str, snapshot_date: dt.date) -> None:
    """Write one snapshot; only its own date partition is replaced."""
    stamped = df.withColumn("snapshot_date", F.lit(snapshot_date))
    (
        stamped.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("snapshot_date")
        .parquet(root)
    )


def snapshots(spark: SparkSession, root: str) -> dict[dt.date, list[str]]:
    """The catalogue of a snapshot folder: for each date the folder or files that hold it.

    A snapshot is a partition `snapshot_date=2024-01-05` or a file or folder `2024-01-05.csv`,
    `.json` or `.parquet`. Spark's own file system lists the root, once; no data are read.
    A missing root has no snapshots.
    """
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[dt.date, list[str]] = {}
    if not system.exists(place):
        return found
    for status in system.listStatus(place):
        name = status.getPath().getName()
        text, _, kind = name.removeprefix("snapshot_date=").partition(".")
        try:
            day = dt.date.fromisoformat(text)
        except ValueError:
            continue
        if name.startswith("snapshot_date=") and not kind or kind in SNAPSHOT_KINDS:
            found.setdefault(day, []).append(status.getPath().toString())
    return found


def latest_snapshot_date(spark: SparkSession, root: str, as_of: dt.date | None = None) -> dt.date | None:
    """Newest snapshot date at or before `as_of`, from the folder list alone."""
    return max((day for day in snapshots(spark, root) if as_of is None or day <= as_of), default=None)


def load_latest(
    spark: SparkSession, root: str, as_of: dt.date | None = None, schema: str | None = None
) -> tuple[DataFrame | None, dt.date | None]:
    """The newest snapshot at or before `as_of`, reading only its files; (None, None) where there is none.

    Give `schema` for CSV and JSON snapshots of any size; without it their types are
    inferred by an extra pass. Several files of one date are one snapshot.
    """
    held = snapshots(spark, root)
    found = max((day for day in held if as_of is None or day <= as_of), default=None)
    if found is None:
        return None, None
    by_kind: dict[str, list[str]] = {}
    for path in held[found]:
        by_kind.setdefault(path.rpartition(".")[2] if path.endswith(SNAPSHOT_KINDS) else "parquet", []).append(path)
    frames = [_read_snapshot(spark, kind, paths, schema) for kind, paths in sorted(by_kind.items())]
    return (frames[0] if len(frames) == 1 else union_all(frames)), found


def _read_snapshot(spark: SparkSession, kind: str, paths: list[str], schema: str | None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    if kind == "csv":
        reader = reader.option("header", True) if schema else reader.options(header=True, inferSchema=True)
    return reader.format(kind).load(paths)


def export_view(df: DataFrame, root: str, name: str, run_date: dt.date) -> DataFrame:
    """Write a run's export partition and expose that run as a temp view."""
    write_snapshot(df, root, run_date)
    exported = df.sparkSession.read.schema(df.schema).parquet(f"{root.rstrip('/')}/snapshot_date={run_date.isoformat()}")
    exported.createOrReplaceTempView(name)
    return exported


def write_report(df: DataFrame, path: str, kind: str = "csv") -> None:
    """Write a small result table (metrics, curves, importances) as one file."""
    writer = df.coalesce(1).write.mode("overwrite")
    if kind == "csv":
        writer.option("header", True).csv(path)
    elif kind == "json":
        writer.json(path)
    else:
        raise ValueError("kind must be 'csv' or 'json'")
