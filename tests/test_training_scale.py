"""Training passes use every core, and a forest's passes do not walk its trees."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallywell.operators import training
from tallywell.session import staged, staged_evenly


def _sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.input_file_name()).count().collect())


def test_large_tables_are_written_evenly_for_all_cores(spark):
    cores = spark.sparkContext.defaultParallelism
    rows = 10_000 * cores + 5
    df = spark.range(0, rows, 1, 2).withColumn("x", F.col("id") * 2)
    sizes = _sizes(staged_evenly(df, rows))
    assert len(sizes) == cores and sum(sizes) == rows and sizes[-1] < 1.1 * sizes[0]


def test_small_tables_are_written_as_they_lie(spark):
    df = spark.range(0, 300, 1, 3)
    assert _sizes(staged_evenly(df, 300)) == _sizes(staged(df)) == [100, 100, 100]


def test_prepared_rows_lie_evenly(spark):
    n = 40_000
    df = spark.range(0, n, 1, 1).select("id", (F.col("id") % 97).cast("double").alias("a"),
                                        (F.col("id") % 3 == 0).cast("int").alias("y"))
    prepared = training.prepare_training(staged(df), "y", ["id"])
    sizes = _sizes(prepared.rows)
    assert len(sizes) == 4 and sum(sizes) == n and sizes[-1] < 1.1 * sizes[0]
    assert prepared.rows.agg(F.sum("weight")).first()[0] == pytest.approx(n, abs=1e-3)


def test_split_rows_lie_evenly(spark):
    n = 40_000
    df = spark.range(0, n, 1, 1).select("id", (F.col("id") % 3 == 0).cast("int").alias("y"))
    train, test = training.hold_out(df, "y", "id")
    for part, rows in ((train, 32_000), (test, 8_000)):
        sizes = _sizes(part)
        assert len(sizes) == 4 and sum(sizes) == rows and sizes[-1] < 1.2 * sizes[0]


def test_forest_is_the_same_with_remembered_nodes(spark):
    rows = [(float((i * 7919) % 101), float((i * 104729) % 89), float((i * 31) % 7 + (i % 17) > 9), 1.0) for i in range(600)]
    made = spark.createDataFrame(rows, "a double, b double, y double, weight double")
    points = staged(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(made.coalesce(2)))
    forest = training.classifier("RandomForest", "y", 600.0, {"n_estimators": 7})
    assert forest.getCacheNodeIds() and forest.getMaxDepth() == training.MAX_DEPTH
    fitted = [forest.copy({forest.cacheNodeIds: kept}).fit(points) for kept in (True, False)]
    assert fitted[0].totalNumNodes > 100
    assert len({m.toDebugString.split("\n", 1)[1] for m in fitted}) == 1
