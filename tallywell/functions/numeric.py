"""Scalar and vector arithmetic expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of exactly this name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def clip(x: Column, low, high) -> Column:
    """``x`` limited to ``[low, high]``; NULL stays NULL."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def similarity_from_distance(d: Column) -> Column:
    return 1.0 / (1.0 + d)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def squared_l2(a: Column, b: Column) -> Column:
    parts = F.zip_with(a.cast("array<double>"), b.cast("array<double>"), lambda x, y: (x - y) * (x - y))
    return F.aggregate(parts, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """Cosine, 0 where a vector is all zero."""
    return F.coalesce(F.try_divide(dot(a, b), norm(a) * norm(b)), F.lit(0.0))


def zero_vector(size: int) -> Column:
    return F.array_repeat(F.lit(0.0), size)
