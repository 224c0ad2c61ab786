"""Shared folder handling: where intermediate tables and checkpoints live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    A local master may fall back to a temporary folder. A cluster without the
    setting is an error, because a machine-local folder would lose data with
    its machine.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = sc.getCheckpointDir()
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallywell-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/tallywell/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where several passes follow: the work before is not repeated, later
    passes prune columns, and a lost executor costs only a re-read.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Rows of a task that pass over a table many times: fewer are not worth a task, more make it long.
LEAST_TASK_ROWS, MOST_TASK_ROWS = 10_000, 200_000


def staged_evenly(df: DataFrame, rows: int, name: str = "stage") -> DataFrame:
    """As :func:`staged`, in even files for all cores.

    For tables that many passes read: otherwise they would lie in as many
    files as the query before had tasks, however many cores wait. Small tables
    are written as they lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(max(cores, rows // MOST_TASK_ROWS), rows // LEAST_TASK_ROWS)
    return staged(df.repartition(parts) if parts > 1 else df, name)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of an input that lies in fewer partitions.

    Meant before costly row work: one file is one task however many cores
    wait. Inputs of at least a partition per core are left as they lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
