"""Table profile, data-quality report, correlation and crosstab operators.

Per-column statistics are columns of one global aggregate and become rows only
at the end, so no pass multiplies the table by its width.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.functions.numeric import named
from tallywell.operators.features import bool_target_to_int, feature_types
from tallywell.operators.quantiles import EXACT_LIMIT, exact_quantiles, quantiles_and

QUARTILES = (0.25, 0.5, 0.75)


def per_column(df: DataFrame, stats: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One aggregate over ``stats[column][statistic]``, returned one row per
    column as ``(column_name, statistic...)``."""
    names = list(stats)
    aggs = [expr.alias(f"{i}_{s}") for i, c in enumerate(names) for s, expr in stats[c].items()]
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"),
                              *[F.col(f"{i}_{s}").alias(s) for s in stats[c]])
                     for i, c in enumerate(names)])
    return df.agg(*aggs).select(F.inline(rows))


def pct(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100.0, whole), 6)


# -- shape, missing values, target -------------------------------------------

def profile_shape(df: DataFrame) -> DataFrame:
    """Row count, column count, and every column with position and type."""
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"),
                              F.lit(i).cast("bigint").alias("position"),
                              F.lit(f.dataType.simpleString()).alias("dtype"))
                     for i, f in enumerate(df.schema.fields)])
    return (df.agg(F.count("*").alias("n_rows"))
            .withColumn("n_columns", F.lit(len(df.columns)).cast("bigint"))
            .select("n_rows", "n_columns", F.inline(rows)))


def profile_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count and share of rows per column."""
    n = F.count("*")
    return per_column(df, {c: {"missing": F.count_if(named(c).isNull()),
                               "missing_pct": pct(F.count_if(named(c).isNull()), n)}
                           for c in columns or df.columns})


def missing_only(profile: DataFrame) -> DataFrame:
    """Only the columns that have missing values."""
    return profile.filter(F.col("missing") > 0)


def profile_target(df: DataFrame, target: str) -> DataFrame:
    """Class counts and shares; NULL labels are left out."""
    counts = (df.filter(named(target).isNotNull()).groupBy(named(target))
              .agg(F.count("*").alias("n")))
    # The window spans classes, not rows.
    return counts.withColumn("pct", pct(F.col("n"), F.sum("n").over(Window.partitionBy())))


# -- numeric columns ----------------------------------------------------------

def profile_numeric(df: DataFrame, columns: Sequence[str], limit: int = EXACT_LIMIT) -> DataFrame:
    """count, mean, std (n - 1), min, quartiles and max per numeric column."""
    x = {c: named(c).cast("double") for c in columns}
    figures = {"n": F.count, "mean": lambda v: F.round(F.mean(v), 4), "std": lambda v: F.round(F.stddev_samp(v), 4),
               "least": F.min, "most": F.max}
    quart, seen = quantiles_and(df, x, QUARTILES, {f"{k}_{i}": f(v) for i, v in enumerate(x.values())
                                                   for k, f in figures.items()}, limit)
    rows = [(c, *[seen[f"{k}_{i}"] for k in ("n", "mean", "std", "least")], *quart[c], seen[f"most_{i}"])
            for i, c in enumerate(columns)]
    made = df.sparkSession.createDataFrame(rows, "column_name string, n long, mean double, std double, min double, "
                                                 "p25 double, p50 double, p75 double, max double")
    return made.withColumns({q: F.round(q, 6) for q in ("p25", "p50", "p75")})


def outlier_bounds(quartiles: Sequence[float | None], factor: float = 1.5) -> tuple[float, float] | None:
    """Fences ``factor`` interquartile ranges outside the quartiles."""
    q1, q3 = quartiles[0], quartiles[-1]
    if q1 is None or q3 is None:
        return None
    return q1 - factor * (q3 - q1), q3 + factor * (q3 - q1)


def dq_outliers_iqr(df: DataFrame, columns: Sequence[str], limit: int = EXACT_LIMIT) -> DataFrame:
    """Values strictly outside the fences, for columns that have any."""
    quart = exact_quantiles(df, {c: named(c) for c in columns}, (0.25, 0.75), limit)
    stats = {}
    for c in columns:
        bounds = outlier_bounds(quart[c])
        if bounds is None:
            continue
        low, high = bounds
        out = F.count_if((named(c) < low) | (named(c) > high))
        stats[c] = {"outliers": out, "outlier_pct": pct(out, F.count("*")),
                    "lower_bound": F.round(F.first(F.lit(low)), 6),
                    "upper_bound": F.round(F.first(F.lit(high)), 6)}
    return per_column(df, stats).filter(F.col("outliers") > 0)


def dq_skewness(df: DataFrame, columns: Sequence[str], threshold: float = 1.0) -> DataFrame:
    """Columns whose population skewness exceeds ``threshold`` in size."""
    return (per_column(df, {c: {"skewness": F.round(F.skewness(named(c).cast("double")), 6)}
                            for c in columns})
            .filter(F.abs("skewness") > threshold))


# -- categorical columns ------------------------------------------------------

def frequency_table(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, n)`` of all columns in one shuffle; hot values
    are combined before it. NULL is kept as a value."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), named(c).cast("string").alias("value"))
                      for c in columns])
    return (df.select(F.inline(pairs)).groupBy("column_name", "value")
            .agg(F.count("*").alias("n")))


def profile_categorical(df: DataFrame, columns: Sequence[str], top: int = 5) -> DataFrame:
    """Distinct count and the ``top`` most frequent values per column.

    The rank keeps ``top`` rows per column and task before its shuffle.
    """
    freq = frequency_table(df, columns).filter(F.col("value").isNotNull())
    distinct = freq.groupBy("column_name").agg(F.count("*").alias("n_distinct"))
    order = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    leading = (freq.withColumn("rank", F.row_number().over(order).cast("bigint"))
               .filter(F.col("rank") <= top))
    return leading.join(distinct, "column_name")


def dq_constant_columns(df: DataFrame, columns: Sequence[str] | None = None,
                        threshold_pct: float = 0.1) -> DataFrame:
    """Columns with fewer distinct values than ``threshold_pct`` of the rows.

    A column with any sketched count far above the threshold cannot be one, so
    only columns near or below it enter the exact distinct count.
    """
    columns = list(columns or df.columns)
    first = df.agg(F.count("*").alias("n"),
                   *[F.approx_count_distinct(named(c), 0.05).alias(f"d{i}") for i, c in enumerate(columns)]).first()
    n = first["n"]
    # 0.05 is the relative standard deviation; a factor of 2 is 20 of them.
    near = [c for i, c in enumerate(columns) if first[f"d{i}"] * 100.0 <= 2 * threshold_pct * n + 2]
    if not near:
        near = columns[:1]
    freq = frequency_table(df, near)
    distinct = freq.groupBy("column_name").agg(
        F.count("value").alias("n_distinct"), F.first(F.lit(n)).alias("n_rows"))
    share = F.try_divide(F.col("n_distinct") * 100.0, F.col("n_rows"))
    return (distinct.filter(share < threshold_pct)
            .select("column_name", "n_distinct", F.round(share, 6).alias("distinct_pct")))


def dq_imbalanced(df: DataFrame, columns: Sequence[str], threshold_pct: float = 90.0) -> DataFrame:
    """Columns where one value holds more than ``threshold_pct`` of non-NULL rows.

    A value in more than half of the rows is named by the majority of each bit
    of the values' hashes; a second aggregate counts it. Neither shuffles more
    than a row per task, however many values there are.
    """
    if threshold_pct < 50:
        raise ValueError("a value below half of the rows need not be the most frequent one")
    hashes = {c: F.xxhash64(named(c).cast("string")) for c in columns}
    bits = df.agg(*[F.sum(F.when(named(c).isNotNull(), 2 * F.getbit(h, F.lit(bit)).cast("long") - 1)).alias(f"{i}_{bit}")
                    for i, (c, h) in enumerate(hashes.items()) for bit in range(64)]).first()
    stats = {}
    for i, (c, h) in enumerate(hashes.items()):
        majority = sum(1 << bit for bit in range(64) if (bits[f"{i}_{bit}"] or 0) > 0)
        same = h == F.lit(majority - (1 << 64) if majority >= 1 << 63 else majority).cast("long")
        stats[c] = {"dominant_value": F.min(F.when(same, named(c).cast("string"))), "n_values": F.count(named(c)),
                    "top_n": F.count_if(same & named(c).isNotNull())}
    share = F.try_divide(F.col("top_n") * 100.0, F.col("n_values"))
    return (per_column(df, stats).filter(share > threshold_pct)
            .select("column_name", "dominant_value", F.round(share, 6).alias("dominant_pct")))


def dq_report(df: DataFrame, target: str | None = None, exclude: Sequence[str] = (),
              limit: int = EXACT_LIMIT) -> DataFrame:
    """All quality findings in one long table ``(issue, column_name, metric, value)``.

    ``constant`` findings on a binary column are expected in tables of more
    than 2,000 rows, because the rule is relative to the row count.
    """
    numeric, categorical = feature_types(df, None, exclude)
    def long(part: DataFrame, issue: str, metrics: Sequence[str]) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                         for m in metrics])
        return part.select(F.lit(issue).alias("issue"), "column_name", F.inline(rows))

    parts = [long(missing_only(profile_missing(df)), "missing", ["missing_pct"]),
             long(dq_constant_columns(df), "constant", ["distinct_pct"])]
    if numeric:
        parts += [long(dq_outliers_iqr(df, numeric, limit), "outliers",
                       ["outliers", "outlier_pct", "lower_bound", "upper_bound"]),
                  long(dq_skewness(df, numeric), "skewed", ["skewness"])]
    if categorical:
        parts.append(long(dq_imbalanced(df, categorical), "imbalanced", ["dominant_pct"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def data_summary(df: DataFrame, target: str | None = None, exclude: Sequence[str] = (),
                 limit: int = EXACT_LIMIT) -> DataFrame:
    """Shape, types, missing values, target shares, numeric statistics and
    leading categories in one long table ``(section, column_name, metric, value)``."""
    numeric, categorical = feature_types(df, None, exclude)

    def long(part: DataFrame, section: str, name: Column, metrics: Sequence[str]) -> DataFrame:
        rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("string").alias("value"))
                         for m in metrics])
        return part.select(F.lit(section).alias("section"), name.alias("column_name"), F.inline(rows))

    column = F.col("column_name")
    parts = [long(profile_shape(df), "shape", column, ["n_rows", "n_columns", "position", "dtype"]),
             long(profile_missing(df), "missing", column, ["missing", "missing_pct"])]
    if target in df.columns:
        parts.append(long(profile_target(df, target), "target", named(target).cast("string"), ["n", "pct"]))
    if numeric:
        parts.append(long(profile_numeric(df, numeric, limit), "numeric", column,
                          ["n", "mean", "std", "min", "p25", "p50", "p75", "max"]))
    if categorical:
        parts.append(long(profile_categorical(df, categorical), "categorical", column,
                          ["rank", "value", "n", "n_distinct"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- correlation --------------------------------------------------------------

def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair over rows where both are
    present, as the lower triangle ``(col_a, col_b, corr)``; NULL if either
    side is constant.

    A task multiplies its rows' values, squares and presence as matrices and
    hands on six sums per pair, whatever columns are missing where. Values are
    centred first so the sums do not cancel.
    """
    columns = list(columns)
    shape = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.avg(named(c).cast("double")).alias(f"m{i}"), F.min(named(c)).alias(f"lo{i}"), F.max(named(c)).alias(f"hi{i}"))]).first()
    centred = df.select(*[(named(c).cast("double") - F.lit(shape[f"m{i}"])).alias(f"x{i}") for i, c in enumerate(columns)])
    low, high = np.array(list(combinations(range(len(columns)), 2)), dtype=np.int32).reshape(-1, 2).T

    def pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(low)))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
            here = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x, nan=0.0)
            both, single, square, product = here.T @ here, x.T @ here, (x * x).T @ here, x.T @ x
            sums += [both[low, high], single[low, high], single[high, low], square[low, high], square[high, low],
                     product[low, high]]
        yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), *[pa.array(s) for s in sums]],
                                         names=["b", "a", "n", "sx", "sy", "sxx", "syy", "sxy"])

    parts = ["n", "sx", "sy", "sxx", "syy", "sxy"]
    name = F.lit(columns)
    pairs = (centred.mapInArrow(pair_sums, "b int, a int, " + ", ".join(f"{p} double" for p in parts))
             .groupBy("a", "b").agg(*[F.sum(p).alias(p) for p in parts])
             .select(name[F.col("a")].alias("col_a"), name[F.col("b")].alias("col_b"), *parts))

    def spread(total, square):
        # Equal values can leave rounding dust; it is no variance.
        left = F.col(square) - F.try_divide(F.col(total) * F.col(total), F.col("n"))
        return F.when(left > 1e-12 * F.col(square), left)

    constant = [c for i, c in enumerate(columns) if shape[f"lo{i}"] == shape[f"hi{i}"]]
    r = F.try_divide(F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n")),
                     F.sqrt(spread("sx", "sxx")) * F.sqrt(spread("sy", "syy")))
    if constant:
        r = F.when(~F.col("col_a").isin(constant) & ~F.col("col_b").isin(constant), r)
    return pairs.select("col_a", "col_b", F.round(r, 6).alias("corr"))


def target_correlation(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, highest first. A boolean
    target counts as 0/1."""
    df = bool_target_to_int(df, target)
    y = named(target).cast("double")
    stats = {}
    for c in columns:
        if c == target:
            continue
        x = named(c).cast("double")
        stats[c] = {"corr": F.round(F.try_divide(
            F.regr_sxy(y, x), F.sqrt(F.regr_sxx(y, x)) * F.sqrt(F.regr_syy(y, x))), 6)}
    return per_column(df, stats).orderBy(F.desc_nulls_last("corr"), "column_name")


def topk_numeric_by_corr(df: DataFrame, columns: Sequence[str], target: str | None, k: int = 10) -> DataFrame:
    """At most ``k`` numeric columns, those most correlated with the target in
    size; without a target the first ``k``."""
    if target is None or target not in df.columns:
        rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("double").alias("abs_corr"))
                         for c in list(columns)[:k]])
        return df.sparkSession.range(1).select(F.inline(rows))
    return (target_correlation(df, columns, target)
            .select("column_name", F.abs("corr").alias("abs_corr"))
            .orderBy(F.desc_nulls_last("abs_corr"), "column_name").limit(k))


def topk_categorical_by_cardinality(df: DataFrame, columns: Sequence[str], k: int = 10) -> DataFrame:
    """At most ``k`` categorical columns with the fewest distinct values."""
    return (frequency_table(df, columns).groupBy("column_name")
            .agg(F.count("value").alias("n_distinct"))
            .orderBy("n_distinct", "column_name").limit(k))


# -- categories against the target ---------------------------------------------

def category_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value, most frequent first; NULL is left out."""
    return (df.filter(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count("*").alias("n")).orderBy(F.desc("n"), column))


def crosstab_pct(df: DataFrame, category: str, target: str, classes: Sequence) -> DataFrame:
    """Share of each target class within a category, in percent of its rows."""
    kept = df.filter(named(category).isNotNull() & named(target).isNotNull())
    n = F.count("*")
    return (kept.groupBy(category)
            .agg(*[pct(F.count_if(named(target) == v), n).alias(f"pct_{v}") for v in classes]))


def label_rate(df: DataFrame, target: str) -> DataFrame:
    """Mean of the target in percent."""
    return df.agg(F.round(F.avg(named(target).cast("double")) * 100, 6).alias("rate_pct"))
