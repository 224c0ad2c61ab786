"""Classifiers, their comparison, tuning, scoring and store."""

from __future__ import annotations

import itertools
import logging
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywell.operators.metrics import evaluate
from tallywell.operators.prep import Preparation, fit_preparation
from tallywell.operators.risk import with_risk
from tallywell.operators.split import stratified_kfold, stratified_split, train_test, with_class_weight
from tallywell.session import shared_dir, staged, staged_evenly

log = logging.getLogger(__name__)

SEED = 42
MODEL_TYPES = ["LogisticRegression", "RandomForest", "GradientBoosting"]
MAX_DEPTH = 30

# Fixed values of the tuning grids. A solver choice and a least split size
# have no counterpart here; depth None is the deepest tree.
GRIDS: dict[str, dict[str, list]] = {
    "LogisticRegression": {"C": [0.01, 0.1, 1, 10, 100]},
    "RandomForest": {
        "n_estimators": [100, 200, 300],
        "max_depth": [None, 10, 20, 30],
        "min_samples_leaf": [1, 2, 4],
        "max_features": ["sqrt", "log2"],
    },
    "GradientBoosting": {
        "n_estimators": [100, 200, 300],
        "learning_rate": [0.01, 0.1, 0.2],
        "max_depth": [3, 5, 7],
        "subsample": [0.8, 0.9, 1.0],
    },
}


def classifier(kind: str, label: str, total_weight: float, params: Mapping | None = None):
    """A Spark ML classifier for ``kind``. Linear and forest models weigh
    classes equally through the ``weight`` column."""
    p = dict(params or {})
    if kind == "LogisticRegression":
        return LogisticRegression(
            labelCol=label, weightCol="weight", maxIter=1000, standardization=False,
            regParam=1.0 / (p.get("C", 1.0) * max(total_weight, 1.0)), elasticNetParam=0.0)
    if kind == "RandomForest":
        return RandomForestClassifier(
            labelCol=label, weightCol="weight", seed=SEED, numTrees=p.get("n_estimators", 100),
            maxDepth=p.get("max_depth") or MAX_DEPTH, minInstancesPerNode=p.get("min_samples_leaf", 1),
            featureSubsetStrategy=p.get("max_features", "sqrt"),
            cacheNodeIds=True)  # a pass looks up a row's node in every tree instead of walking down from the root
    if kind == "GradientBoosting":
        return GBTClassifier(
            labelCol=label, seed=SEED, maxIter=p.get("n_estimators", 100), maxDepth=p.get("max_depth") or 3,
            stepSize=p.get("learning_rate", 0.1), subsamplingRate=p.get("subsample", 1.0))
    raise ValueError(f"unsupported model type: {kind}")


@dataclass
class Prepared:
    """Prepared training rows ``(features, label, weight)`` and what made them."""

    rows: DataFrame
    preparation: Preparation
    label: str
    total_weight: float


def prepare_training(train: DataFrame, label: str, exclude: Iterable[str] = ()) -> Prepared:
    """Fit the preparation on ``train`` and write the prepared rows once, evenly
    for all cores; all models and iterations read that table."""
    shared_dir(train.sparkSession)  # boosting cuts its lineage there
    prep = fit_preparation(train, label, exclude)
    ready = with_class_weight(prep.transform(train).withColumn(label, F.col(label).cast("double")), label)
    rows = staged_evenly(ready.select("features", label, "weight"), train.count(), "prepared")
    total = rows.agg(F.sum("weight")).first()[0] or 0.0
    return Prepared(rows, prep, label, total)


def fit_model(prepared: Prepared, kind: str, params: Mapping | None = None) -> PipelineModel:
    """Train one classifier; the result scores raw rows."""
    fitted = classifier(kind, prepared.label, prepared.total_weight, params).fit(prepared.rows)
    return prepared.preparation.model(fitted)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Input columns with ``churn_prediction``, ``churn_probability`` and
    ``risk_category``. Narrow: rows are scored where they lie."""
    scored = model.transform(df).select(
        *df.columns, F.col("prediction").cast("int").alias("churn_prediction"),
        vector_to_array("probability")[1].alias("churn_probability"))
    return with_risk(scored, "churn_probability")


@dataclass
class Comparison:
    models: dict[str, PipelineModel]
    metrics: DataFrame
    best: str
    preparation: Preparation


METRIC_SCHEMA = T.StructType(
    [T.StructField("model", T.StringType()), T.StructField("ordinal", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in
       ("accuracy", "precision", "recall", "f1_score", "roc_auc", "pr_auc")])


def evaluate_model(model: PipelineModel, test: DataFrame, label: str) -> dict[str, float]:
    return evaluate(score(model, test), label, "churn_prediction", "churn_probability")


def compare_models(train: DataFrame, test: DataFrame, label: str, exclude: Iterable[str] = (),
                   kinds: Sequence[str] | None = None, params: Mapping[str, Mapping] | None = None) -> Comparison:
    """Train every kind on the same prepared rows and evaluate it on ``test``;
    the highest ROC area wins, the earlier kind on ties."""
    prepared = prepare_training(train, label, exclude)
    models, rows = {}, []
    for i, kind in enumerate(kinds or MODEL_TYPES):
        models[kind] = fit_model(prepared, kind, (params or {}).get(kind))
        rows.append({"model": kind, "ordinal": i, **evaluate_model(models[kind], test, label)})
        log.info("%s: %s", kind, rows[-1])
    best = max(rows, key=lambda r: (r["roc_auc"] or 0.0, -r["ordinal"]))["model"]
    metrics = train.sparkSession.createDataFrame(
        [tuple(r[f.name] for f in METRIC_SCHEMA.fields) for r in rows], METRIC_SCHEMA)
    return Comparison(models, metrics, best, prepared.preparation)


def grid(kind: str, grids: Mapping[str, Mapping[str, list]] = GRIDS) -> list[dict]:
    """All parameter combinations of ``kind``."""
    names = list(grids[kind])
    return [dict(zip(names, values)) for values in itertools.product(*(grids[kind][n] for n in names))]


def nested(combos: Sequence[dict]) -> list[tuple[dict, dict[int, int]]]:
    """Combinations that differ in ``n_estimators`` only, as the largest of them and the place of each number of trees.

    The first trees of an ensemble are a smaller one, so one fit serves them all.
    """
    groups: dict[tuple, dict[int, int]] = {}
    for i, combo in enumerate(combos):
        rest = tuple(sorted((k, repr(v)) for k, v in combo.items() if k != "n_estimators"))
        groups.setdefault(rest, {})[combo.get("n_estimators", 0)] = i
    return [(combos[sizes[max(sizes)]], sizes) for sizes in groups.values()]


def first_trees(fitted, trees: int):
    """The model of the first ``trees`` trees of a fitted ensemble.

    For boosting it is the model that fewer iterations give. For a forest it is
    one that fewer trees could give: Spark draws other rows and columns for a
    forest of another size.
    """
    if not trees or trees >= fitted.getNumTrees:
        return fitted
    whole, sc = fitted._java_obj, SparkSession.active().sparkContext
    ml = sc._jvm.org.apache.spark.ml

    def first(values, kind):
        kept = sc._gateway.new_array(kind, trees)
        for i in range(trees):
            kept[i] = values[i]
        return kept

    if isinstance(fitted, GBTClassificationModel):
        kept = first(whole.trees(), ml.regression.DecisionTreeRegressionModel)
        return type(fitted)(ml.classification.GBTClassificationModel(
            whole.uid(), kept, first(whole.treeWeights(), sc._jvm.double)))
    kept = first(whole.trees(), ml.classification.DecisionTreeClassificationModel)
    return type(fitted)(ml.classification.RandomForestClassificationModel(
        whole.uid(), kept, whole.numFeatures(), whole.numClasses()))


@dataclass
class Tuned:
    model: PipelineModel
    params: dict
    results: DataFrame


def grid_search(train: DataFrame, label: str, id_col: str, kind: str, exclude: Iterable[str] = (),
                folds: int = 5, combos: Sequence[dict] | None = None, parallelism: int = 4) -> Tuned:
    """Best parameters by mean ROC area over stratified folds, refitted on all
    training rows. The preparation is fitted anew on each fold's training part.
    Combinations that differ in their number of trees share one fit a fold."""
    spark = train.sparkSession
    combos = list(combos if combos is not None else grid(kind))
    exclude = [*exclude, "fold"]
    folded = staged_evenly(stratified_kfold(train, label, id_col, folds, SEED), train.count(), "folds")
    areas: list[list[float]] = [[] for _ in combos]
    for fold in range(folds):
        prepared = prepare_training(folded.filter(F.col("fold") != fold), label, exclude)
        held = staged(prepared.preparation.transform(folded.filter(F.col("fold") == fold))
                      .select("features", F.col(label).cast("double").alias(label)), "held")

        def run(group, prepared=prepared, held=held):
            params, sizes = group
            fitted = classifier(kind, label, prepared.total_weight, params).fit(prepared.rows)
            found = []
            for trees, i in sizes.items():
                out = first_trees(fitted, trees).transform(held).select(
                    label, F.col("prediction").cast("int").alias("p"), vector_to_array("probability")[1].alias("s"))
                found.append((i, evaluate(out, label, "p", "s")["roc_auc"] or 0.0))
            return found

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            for i, area in itertools.chain.from_iterable(pool.map(run, nested(combos))):
                areas[i].append(area)
    means = [sum(a) / len(a) for a in areas]
    best = max(range(len(combos)), key=lambda i: (means[i], -i))
    rows = [(i, kind, str(combos[i]), float(means[i]), i == best) for i in range(len(combos))]
    results = spark.createDataFrame(rows, "ordinal int, model string, params string, mean_roc_auc double, best boolean")
    model = fit_model(prepare_training(train, label, exclude[:-1]), kind, combos[best])
    return Tuned(model, combos[best], results)


def hold_out(df: DataFrame, label: str, id_col: str, test_size: float = 0.2, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Stratified training and test rows. ``df`` is computed once, and so is
    the split, which reads its input several times."""
    labelled = staged(df, "labelled")
    split = stratified_split(labelled, label, id_col, test_size, seed)
    return train_test(staged_evenly(split, labelled.count(), "split"))


# -- store ----------------------------------------------------------------------

def save_model(model: PipelineModel, directory: str, spark: SparkSession, stamp: str | None = None) -> str:
    """Save as ``churn_model_<time>`` and name it in ``LATEST``, which only
    grows. A model of that name is not replaced."""
    stamp = stamp or datetime.now().strftime("%Y%m%d_%H%M%S_%f")
    path = f"{directory.rstrip('/')}/churn_model_{stamp}"
    model.write().save(path)
    spark.createDataFrame([(stamp, path)], "stamp string, path string").coalesce(1).write.mode("append").json(
        f"{directory.rstrip('/')}/LATEST")
    return path


def load_model(directory: str, spark: SparkSession, path: str | None = None) -> PipelineModel:
    """Load ``path``, or the latest model of ``directory``."""
    if path is None:
        path = (spark.read.schema("stamp string, path string").json(f"{directory.rstrip('/')}/LATEST")
                .orderBy(F.col("stamp").desc()).first()["path"])
    return PipelineModel.load(path)


def model_metadata(spark: SparkSession, kind: str, target: str, performance: Mapping[str, float],
                   features: Sequence[str], path: str) -> DataFrame:
    """One row about a trained model, to be written as JSON."""
    row = (kind, target, {k: float(performance[k]) for k in ("accuracy", "roc_auc", "f1_score")},
           list(features), datetime.now().isoformat(), path)
    return spark.createDataFrame([row], "model_type string, target_column string, "
                                 "performance map<string,double>, feature_names array<string>, "
                                 "created_at string, model_path string")
