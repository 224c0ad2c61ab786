"""Imputation, scaling and encoding, fitted on training rows.

Fitted figures become literals of an ``SQLTransformer``, so a saved pipeline
carries them and runs as a plain projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.functions.numeric import named
from tallywell.operators.features import derived_sql, feature_types
from tallywell.operators.profile import frequency_table
from tallywell.operators.quantiles import EXACT_LIMIT, exact_quantiles
from tallywell.session import staged


def medians(df: DataFrame, columns: Sequence[str], limit: int = EXACT_LIMIT) -> dict[str, float | None]:
    """Exact, interpolated medians; NULLs ignored."""
    return {c: v[0] for c, v in exact_quantiles(df, {c: named(c) for c in columns}, [0.5], limit).items()}


def modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per column; the smallest of equals."""
    if not columns:
        return {}
    best = (frequency_table(df, columns).filter(F.col("value").isNotNull())
            .groupBy("column_name").agg(F.min(F.struct((-F.col("n")).alias("neg"), "value")).alias("top")))
    found = {r["column_name"]: r["top"]["value"] for r in best.collect()}
    return {c: found.get(c) for c in columns}


def impute_median(df: DataFrame, fitted: dict[str, float | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(named(c).cast("double"), F.lit(v).cast("double"))
                           for c, v in fitted.items()})


def impute_mode(df: DataFrame, fitted: dict[str, str | None]) -> DataFrame:
    return df.withColumns({c: F.coalesce(named(c), F.lit(v).cast("string")) for c, v in fitted.items()})


def scaling(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a zero deviation becomes 1."""
    if not columns:
        return {}
    row = df.agg(*[a for i, c in enumerate(columns) for a in (
        F.avg(named(c).cast("double")).alias(f"m{i}"), F.stddev_pop(named(c).cast("double")).alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"] or 0.0, row[f"s{i}"] or 1.0) for i, c in enumerate(columns)}


def standardize(df: DataFrame, fitted: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (named(c).cast("double") - m) / F.lit(s) for c, (m, s) in fitted.items()})


# Most values of a column that is encoded: they are slots of the model and pass through the driver.
MAX_CATEGORIES = 10_000


def check_categories(df: DataFrame, columns: Sequence[str], limit: int = MAX_CATEGORIES) -> None:
    """Raise an error that names the columns with more than about ``limit`` values."""
    if not columns:
        return
    counts = df.agg(*[F.approx_count_distinct(named(c), 0.02).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    wide = [f"{c} ({counts[f'n{i}']})" for i, c in enumerate(columns) if counts[f"n{i}"] > limit]
    if wide:
        raise ValueError(f"more than {limit} values, exclude or group them first: {', '.join(wide)}")


def one_hot_stages(columns: Sequence[str]) -> list:
    """Indexers in value order and an encoder whose dropped last slot stands
    for a value not seen in training: it encodes to all zeros."""
    return [StringIndexer(inputCols=[f"cat_{c}" for c in columns], outputCols=[f"index_{c}" for c in columns],
                          stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=[f"index_{c}" for c in columns],
                          outputCols=[f"onehot_{c}" for c in columns], dropLast=True)]


@dataclass
class Preparation:
    """Fitted preparation: pipeline stages and what they were fitted to."""

    stages: list
    numeric: list[str]
    categorical: list[str]
    inputs: list[str]
    median: dict[str, float | None]
    mode: dict[str, str | None]
    labels: dict[str, list[str]] = field(default_factory=dict)

    def model(self, *extra) -> PipelineModel:
        return PipelineModel([*self.stages, *extra])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model().transform(df)

    @property
    def slots(self) -> list[str]:
        """Names of the feature vector's elements."""
        return self.numeric + [f"{c}={v}" for c in self.categorical for v in self.labels[c]]


def fit_preparation(train: DataFrame, target: str, exclude: Iterable[str] = (),
                    limit: int = EXACT_LIMIT) -> Preparation:
    """Fit feature engineering, imputation, scaling and encoding on ``train``.

    Numeric and string columns other than ``target`` and ``exclude`` are
    features; every other type is left out. Columns without any value are too.
    """
    inputs = [c for c in train.columns if c != target]
    derived = derived_sql([c for c in train.columns if c != target and c not in set(exclude)])
    engineer = SQLTransformer(statement="SELECT " + ", ".join(
        ["*"] + [f"{e} AS `{n}`" for n, e in derived.items() if n not in train.columns]) + " FROM __THIS__")
    # Several passes follow; the features are derived once.
    wide = staged(engineer.transform(train), "engineered")
    numeric, categorical = feature_types(wide, target, exclude)
    check_categories(wide, categorical)
    median = medians(wide, numeric, limit)
    mode = modes(wide, categorical)
    numeric = [c for c in numeric if median[c] is not None]
    categorical = [c for c in categorical if mode[c] is not None]
    scale = scaling(impute_median(wide, {c: median[c] for c in numeric}), numeric)

    parts = ["*"]
    for c in numeric:
        mean, dev = scale[c]
        parts.append(f"(coalesce(double(`{c}`), {median[c]!r}D) - ({mean!r}D)) / ({dev!r}D) AS `num_{c}`")
    for c in categorical:
        value = mode[c].replace("\\", "\\\\").replace("'", "\\'")
        parts.append(f"coalesce(`{c}`, '{value}') AS `cat_{c}`")
    fill = SQLTransformer(statement=f"SELECT {', '.join(parts)} FROM __THIS__")

    stages: list = [engineer, fill]
    labels: dict[str, list[str]] = {}
    if categorical:
        current = fill.transform(wide)
        indexer, encoder = one_hot_stages(categorical)
        index_model = indexer.fit(current)
        stages += [index_model, encoder.fit(index_model.transform(current))]
        labels = {c: list(v) for c, v in zip(categorical, index_model.labelsArray)}
    stages.append(VectorAssembler(inputCols=[f"num_{c}" for c in numeric] + [f"onehot_{c}" for c in categorical],
                                  outputCol="features"))
    return Preparation(stages, numeric, categorical, inputs, median, mode, labels)
