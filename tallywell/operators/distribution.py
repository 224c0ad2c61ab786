"""Histogram, density and box statistics per numeric column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.operators.profile import outlier_bounds
from tallywell.functions.numeric import named
from tallywell.operators.quantiles import EXACT_LIMIT, exact_quantiles


def _ranges(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.min(named(c).cast("double")).alias(f"lo{i}"), F.max(named(c).cast("double")).alias(f"hi{i}"))]).first()
    return {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(columns) if row[f"lo{i}"] is not None}


def histogram_by_class(df: DataFrame, columns: Sequence[str], target: str | None = None,
                       bins: int = 20) -> DataFrame:
    """Counts in ``bins`` equal bins over each column's range, per class:
    ``(column_name, bin, bin_low, bin_high, target, n)``."""
    ranges = _ranges(df, columns)
    cells = []
    for c, (lo, hi) in ranges.items():
        width = (hi - lo) / bins
        x = named(c).cast("double")
        b = (F.lit(0) if width == 0 else
             F.least(F.lit(bins - 1), F.floor((x - lo) / F.lit(width))))
        cells.append(F.when(x.isNotNull(), F.struct(
            F.lit(c).alias("column_name"), b.cast("bigint").alias("bin"),
            F.lit(lo).alias("lo"), F.lit(width).alias("width"))))
    label = named(target) if target else F.lit(None).cast("int")
    return (df.select(label.alias("target"), F.explode(F.array_compact(F.array(*cells))).alias("c"))
            .groupBy("c.column_name", "c.bin", "c.lo", "c.width", "target")
            .agg(F.count("*").alias("n"))
            .select("column_name", "bin", F.round(F.col("lo") + F.col("bin") * F.col("width"), 4).alias("bin_low"),
                    F.round(F.col("lo") + (F.col("bin") + 1) * F.col("width"), 4).alias("bin_high"),
                    "target", "n"))


def density_curve(df: DataFrame, columns: Sequence[str], bins: int = 100, points: int = 50) -> DataFrame:
    """Gaussian density of each column at ``points`` + 1 places of its range.

    Rows are first counted in ``bins`` bins, so the kernel work is
    ``bins * points`` per column whatever the row count. Bandwidth is the
    sample deviation times ``n ** (-1/5)``.
    """
    first = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.min(named(c).cast("double")).alias(f"lo{i}"), F.max(named(c).cast("double")).alias(f"hi{i}"),
        F.count(named(c)).alias(f"n{i}"), F.stddev_samp(named(c).cast("double")).alias(f"sd{i}"))]).first()
    cells = []
    for i, c in enumerate(columns):
        lo, hi, n, sd = (first[f"{k}{i}"] for k in ("lo", "hi", "n", "sd"))
        if not n or not sd or lo == hi:
            continue
        width = (hi - lo) / bins
        x = named(c).cast("double")
        cells.append(F.when(x.isNotNull(), F.struct(
            F.lit(c).alias("column_name"),
            F.least(F.lit(bins - 1), F.floor((x - lo) / F.lit(width))).cast("bigint").alias("bin"),
            F.lit(lo).alias("lo"), F.lit(hi).alias("hi"), F.lit(float(n)).alias("n"),
            F.lit(sd * n ** -0.2).alias("h"))))
    counts = (df.select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
              .groupBy("c.column_name", "c.bin", "c.lo", "c.hi", "c.n", "c.h")
              .agg(F.count("*").alias("k")))
    grid = counts.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points))))
    x = F.col("lo") + F.col("point") * (F.col("hi") - F.col("lo")) / points
    centre = F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins
    z = (x - centre) / F.col("h")
    kernel = F.col("k") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("h") * F.sqrt(2 * F.pi()))
    return (grid.groupBy("column_name", F.col("point").cast("bigint").alias("point"))
            .agg(F.round(F.first(x), 4).alias("x"), F.round(F.sum(kernel), 9).alias("density")))


def boxplot_stats(df: DataFrame, columns: Sequence[str], target: str, classes: Sequence,
                  limit: int = EXACT_LIMIT) -> DataFrame:
    """Quartiles, whiskers (extreme values inside the fences) and outlier count
    per column and target class."""
    cells = {f"{c}|{v}": (c, v, F.when(named(target) == v, named(c).cast("double")))
             for c in columns for v in classes}
    quart = exact_quantiles(df, {k: x for k, (_, _, x) in cells.items()}, (0.25, 0.5, 0.75), limit)
    aggs, rows = [], []
    for i, (k, (c, v, x)) in enumerate(cells.items()):
        bounds = outlier_bounds(quart[k])
        if bounds is None:
            continue
        low, high = bounds
        inside = F.when(x.between(low, high), x)
        aggs += [F.min(inside).alias(f"a{i}"), F.max(inside).alias(f"b{i}"),
                 F.count_if((x < low) | (x > high)).alias(f"o{i}")]
        q = quart[k]
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(v).alias("target"),
                             *[F.round(F.lit(q[j]), 6).alias(m) for j, m in enumerate(("p25", "p50", "p75"))],
                             F.col(f"a{i}").alias("whisker_low"), F.col(f"b{i}").alias("whisker_high"),
                             F.col(f"o{i}").alias("outliers")))
    return df.agg(*aggs).select(F.inline(F.array(*rows)))
