"""Store of tables in versions that are never changed once they can be read.

A version's tables lie in a folder of their own, divided by a hash of their key.
A manifest row, appended last, names for every table and bucket the folder that
holds it; a version without one does not exist for readers. Replacing the rows
of some keys rewrites the buckets of those keys only, and the new manifest names
the old folders for all others. A reader keeps the version it has opened.

One writer at a time is assumed. Old folders stay until a retention rule of the
shared folder takes them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a new store; a larger one has a bucket for every few hundred megabytes.
BUCKETS = 64
COLUMN = "bucket_of_key"
MANIFEST = "version long, buckets int, note string, tables string"


@dataclass
class Snapshot:
    version: int
    buckets: int
    note: dict[str, str]
    tables: dict[str, dict]  # name: {"schema": ..., "folders": {bucket: folder}}


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The latest version of the store, or the one asked for; None if there is none."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifests")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if version is not None:
        rows = rows.where(F.col("version") == version)
    row = rows.orderBy(F.col("version").desc()).first()
    return None if row is None else Snapshot(row.version, row.buckets, json.loads(row.note), json.loads(row.tables))


def read_table(spark: SparkSession, held: Snapshot, name: str, buckets: set[int] | None = None) -> DataFrame:
    """A table of a version, or the part of it in some buckets."""
    table = held.tables[name]
    schema = T.StructType.fromJson(table["schema"])
    paths = [f"{folder}/{name}/{COLUMN}={b}" for b, folder in table["folders"].items() if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def publish(spark: SparkSession, path: str, tables: dict[str, DataFrame], key: str, replaced: DataFrame | None = None,
            note: dict[str, str] | None = None, buckets: int = BUCKETS) -> Snapshot:
    """Write a new version. ``tables`` have the column ``key``.

    With ``replaced``, a table of keys, the rows of those keys give way to the
    rows of ``tables`` and all others stay; without it the tables are all there
    is. Null keys are keys like others.
    """
    old = snapshot(spark, path)
    if replaced is not None and old is None:
        replaced = None
    buckets = old.buckets if replaced is not None else buckets
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    folder = f"{path}/versions/{uuid.uuid4().hex}"
    held: dict[str, dict] = {}
    touched: set[int] = set()
    if replaced is not None:
        gone = replaced.select(F.col(key).alias("gone")).distinct()
        # As many rows as the store has buckets at most.
        touched = {r[0] for r in replaced.select(bucket).distinct().collect()}
        missing = set(old.tables) - set(tables)
        if missing:
            raise ValueError(f"no rows given for {sorted(missing)}")
    for name, fresh in tables.items():
        rows, folders = fresh, {}
        if replaced is not None:
            kept = read_table(spark, old, name, touched)
            rows = kept.join(gone, F.col(key).eqNullSafe(F.col("gone")), "left_anti").unionByName(fresh.select(*kept.columns))
            folders = {b: f for b, f in old.tables[name]["folders"].items() if int(b) not in touched}
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in rows.schema.fields])
        rows.withColumn(COLUMN, bucket).repartition(COLUMN).write.partitionBy(COLUMN).parquet(f"{folder}/{name}")
        written = spark.read.schema(T.StructType([*schema.fields, T.StructField(COLUMN, T.IntegerType())])).parquet(f"{folder}/{name}")
        folders |= {str(r[0]): folder for r in written.select(COLUMN).distinct().collect()}
        held[name] = {"schema": json.loads(schema.json()), "folders": folders}
    made = Snapshot((old.version if old else 0) + 1, buckets, note if note is not None else (old.note if old else {}), held)
    # Last: until this row is there, readers find the version before.
    spark.createDataFrame([(made.version, made.buckets, json.dumps(made.note), json.dumps(made.tables))], MANIFEST) \
        .coalesce(1).write.mode("append").parquet(f"{path}/manifests")
    return made
