"""Written tables that cut lineage, kept in the cluster's shared checkpoint folder."""

from __future__ import annotations

import math
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfsight.settings import LOOP_ROWS, TASK_ROWS


def scratch_root(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`; tests on a local master get a new one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root is None:
        if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="shelfsight-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_root(spark)}/shelfsight/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage", compression: str | None = None) -> DataFrame:
    """Write `df` once and read it back.

    Later passes then see the same rows in the same slices, also after an
    executor is lost, and read only the columns they use.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def sized_session(spark: SparkSession, tasks: int) -> SparkSession:
    """A session beside `spark` with its settings, whose shuffles have `tasks` tasks; `spark` stays as it is."""
    beside = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if beside.conf.isModifiable(key):
            beside.conf.set(key, value)
    beside.conf.set("spark.sql.shuffle.partitions", str(tasks))
    return beside


def materialize_for_loop(df: DataFrame, label: str = "stage") -> DataFrame:
    """As `materialize`, for a loop of many short jobs over the same rows.

    The rows are dealt out to files of about LOOP_ROWS rows and read in a session whose
    shuffles have as many tasks: with the caller's number, starting nearly empty tasks
    would take most of each job. There are never more tasks than the caller's number,
    unless it leaves more than TASK_ROWS rows to one.
    """
    written = materialize(df, label)
    spark, rows = df.sparkSession, written.count()
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / TASK_ROWS))
    tasks = min(max(math.ceil(rows / LOOP_ROWS), 1), most)
    path = scratch_path(spark, label)
    written.repartition(tasks).write.parquet(path)
    return sized_session(spark, tasks).read.schema(df.schema).parquet(path)
