"""Exact ranks and running totals without a single-task sort.

Both operators cut the order into many buckets, total the buckets on a small
table, and order rows only inside a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the hash that name a bucket: 16 ** 4 buckets per group.
PREFIX_DIGITS = 4
RUNNING_BUCKETS = 1024


def hash_key(id_col: str, seed: int) -> Column:
    """Pseudo-random but repeatable order of rows."""
    return F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.lit(str(seed))))


def hash_cuts(df: DataFrame, group: str, id_col: str, seed: int, ranks: Sequence[Column]) -> DataFrame:
    """Per group, the hash of the row at each wanted rank of the hash order:
    ``(group, cut_1, cut_2, ...)``; NULL for rank 0.

    ``ranks`` are expressions over the group size ``n``. Only rows of the one
    bucket that holds a cut are ordered, a 65,536th of a group, so the large
    table is counted map-side and never shuffled.
    """
    keyed = df.select(F.col(group).alias("g"), hash_key(id_col, seed).alias("h"))
    prefix = F.substring("h", 1, PREFIX_DIGITS)
    counts = keyed.groupBy("g", prefix.alias("prefix")).agg(F.count("*").alias("c"))
    # At most 16 ** PREFIX_DIGITS rows per group from here on.
    running = Window.partitionBy("g").orderBy("prefix")
    whole = Window.partitionBy("g")
    cum = (counts.withColumn("upto", F.sum("c").over(running))
           .withColumn("n", F.sum("c").over(whole)))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("cut"), r.cast("bigint").alias("rank"))
                                 for i, r in enumerate(ranks)]))
    spots = (cum.select("*", wanted.alias("w"))
             .filter((F.col("w.rank") > F.col("upto") - F.col("c")) & (F.col("w.rank") <= F.col("upto")))
             .select("g", "prefix", F.col("w.cut").alias("cut"),
                     (F.col("w.rank") - F.col("upto") + F.col("c")).alias("offset")))
    # One row per group and cut; their number is the data's, so the join is left to Spark.
    inside = (keyed.withColumn("prefix", prefix).join(spots, ["g", "prefix"])
              .withColumn("r", F.row_number().over(Window.partitionBy("g", "cut").orderBy("h")))
              .filter(F.col("r") == F.col("offset")))
    return (inside.groupBy(F.col("g").alias(group))
            .agg(*[F.max(F.when(F.col("cut") == i, F.col("h"))).alias(f"cut_{i + 1}")
                   for i in range(len(ranks))]))


def with_cut_index(df: DataFrame, cuts: DataFrame, group: str, id_col: str, seed: int, n_cuts: int,
                   name: str) -> DataFrame:
    """Append how many cuts lie strictly before a row's hash (0 .. n_cuts)."""
    h = hash_key(id_col, seed)
    index = F.lit(0)
    for i in range(1, n_cuts + 1):
        cut = F.col(f"cut_{i}")
        index = index + F.when(cut.isNull() | (h > cut), 1).otherwise(0)
    # One row per class; rows without a class have no cut and are left out.
    return (df.join(cuts, group).withColumn(name, index)
            .drop(*[f"cut_{i}" for i in range(1, n_cuts + 1)]))


def running_totals(df: DataFrame, order: str, sums: Sequence[str]) -> DataFrame:
    """Running sums over ``order`` descending, one input row per ``order``
    value; adds ``cum_<name>`` columns and the grand totals ``all_<name>``.

    Bucket edges come from a quantile sketch, so buckets stay even for any
    distribution of the values, and equal values share a bucket.
    """
    points = [i / RUNNING_BUCKETS for i in range(1, RUNNING_BUCKETS)]
    edges = df.agg(F.percentile_approx(F.col(order), points, 4 * RUNNING_BUCKETS)).first()[0] or []
    splits = [-math.inf, *sorted(set(edges)), math.inf]
    bucketed = Bucketizer(splits=splits, inputCol=order, outputCol="bucket",
                          handleInvalid="keep").transform(df)
    # At most RUNNING_BUCKETS + 1 rows: the window below is small.
    totals = bucketed.groupBy("bucket").agg(*[F.sum(s).alias(f"t_{s}") for s in sums])
    later = Window.orderBy(F.desc("bucket"))
    totals = totals.select(
        "bucket",
        *[(F.sum(f"t_{s}").over(later) - F.col(f"t_{s}")).alias(f"before_{s}") for s in sums],
        *[F.sum(f"t_{s}").over(Window.partitionBy()).alias(f"all_{s}") for s in sums])
    within = Window.partitionBy("bucket").orderBy(F.desc(order))
    return (bucketed.join(F.broadcast(totals), "bucket")
            .withColumns({f"cum_{s}": F.col(f"before_{s}") + F.sum(s).over(within) for s in sums})
            .drop("bucket", *[f"before_{s}" for s in sums]))
