"""Feature typing and derived customer features."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Right-closed tenure bins in months, the last one open-ended.
TENURE_BINS = [(0, 6, "0-6 months"), (6, 12, "6-12 months"), (12, 24, "1-2 years"),
               (24, 36, "2-3 years"), (36, None, "3+ years")]

SERVICE_PREFIX = "service_"


def feature_types(df: DataFrame, target: str | None = None,
                  exclude: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names. Booleans, dates and nested types
    are in neither list."""
    skip = set(exclude) | ({target} if target else set())
    fields = [f for f in df.schema.fields if f.name not in skip]
    return ([f.name for f in fields if isinstance(f.dataType, T.NumericType)],
            [f.name for f in fields if isinstance(f.dataType, T.StringType)])


def split_target(df: DataFrame, target: str, id_cols: Sequence[str] = ()) -> tuple[DataFrame, DataFrame | None]:
    """Features and target as two projections of the same rows; the target is
    None if the column is absent. ``id_cols`` stay in both."""
    if target not in df.columns:
        return df, None
    return df.drop(target), df.select(*id_cols, target)


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient in double; NULL where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_sql(numerator: str, denominator: str) -> str:
    return f"try_divide(double({numerator}), double({denominator}))"


def tenure_group_sql(tenure: str = "tenure") -> str:
    """Right-closed bin label; 0, negative and NULL tenure have none."""
    cases = [f"WHEN {tenure} > {low}" + (f" AND {tenure} <= {high}" if high is not None else "") + f" THEN '{name}'"
             for low, high, name in TENURE_BINS]
    return f"CASE {' '.join(cases)} END"


def total_services_sql(columns: Sequence[str]) -> str:
    """Row sum where NULL counts as 0."""
    return " + ".join(f"coalesce(`{c}`, 0)" for c in columns)


def derived_sql(columns: Sequence[str]) -> dict[str, str]:
    """SQL of every derived feature whose inputs are among ``columns``. The
    same text serves a projection and a saved pipeline stage."""
    have = set(columns)
    out: dict[str, str] = {}
    if {"usage_frequency", "contract_duration"} <= have:
        out["usage_per_month"] = ratio_sql("usage_frequency", "contract_duration")
    if {"revenue", "cost"} <= have:
        out["margin"] = "revenue - cost"
        out["margin_percentage"] = ratio_sql("revenue - cost", "revenue") + " * 100"
    if "tenure" in have:
        out["tenure_group"] = tenure_group_sql()
    services = [c for c in columns if c.startswith(SERVICE_PREFIX)]
    if len(services) > 1:
        out["total_services"] = total_services_sql(services)
    if {"support_calls", "tenure"} <= have:
        out["support_calls_per_month"] = ratio_sql("support_calls", "tenure")
    return out


def derived_features(columns: Sequence[str]) -> dict[str, Column]:
    """:func:`derived_sql` as columns."""
    return {n: F.expr(s) for n, s in derived_sql(columns).items()}


def engineer_features(df: DataFrame) -> DataFrame:
    """Append all derived features in one projection over the input columns."""
    return df.withColumns(derived_features(df.columns))


def bool_target_to_int(df: DataFrame, target: str) -> DataFrame:
    """Cast a boolean target to 0/1 and leave any other type alone."""
    if isinstance(df.schema[target].dataType, T.BooleanType):
        return df.withColumn(target, F.col(target).cast("int"))
    return df


def lump_other(df: DataFrame, column: str, keep: int = 15, other: str = "Other",
               into: str | None = None) -> DataFrame:
    """Replace all but the ``keep`` most frequent values, and NULL, by
    ``other``. A column with at most ``keep`` values is unchanged.

    Only the ``keep`` + 1 leading values reach the driver, so the rewrite is a
    narrow projection.
    """
    leading = (df.filter(F.col(column).isNotNull()).groupBy(column).count()
               .orderBy(F.desc("count"), column).limit(keep + 1).collect())
    into = into or column
    if len(leading) <= keep:
        return df.withColumn(into, F.col(column))
    top = [r[0] for r in leading[:keep]]
    return df.withColumn(into, F.when(F.col(column).isin(top), F.col(column)).otherwise(other))
