"""Models: quality above chance, reload equality, additive explanations."""

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallywell.operators import explain, training
from tallywell.plans.customer_view import scored_customers
from tallywell.plans.pipeline import run_risk_pipeline
from tallywell.session import staged

BASE = "/root/testdata/sf0.001"
LABEL = "label_sig"


@pytest.fixture(scope="module")
def data(spark):
    return staged(scored_customers(spark, BASE).drop("rule_score", "pred", "Churn"))


@pytest.fixture(scope="module")
def compared(data):
    train, test = training.hold_out(data, LABEL, "customer_id")
    small = {"RandomForest": {"n_estimators": 20, "max_depth": 5}, "GradientBoosting": {"n_estimators": 10}}
    return train, test, training.compare_models(train, test, LABEL, ["customer_id"], params=small)


def test_models_learn(compared):
    rows = compared[2].metrics.collect()
    assert [r["model"] for r in rows] == training.MODEL_TYPES
    assert all(r["roc_auc"] > 0.7 for r in rows)
    assert compared[2].best == max(rows, key=lambda r: r["roc_auc"])["model"]


def test_scores_survive_the_store(spark, compared, tmp_path):
    _, test, c = compared
    model = c.models["RandomForest"]
    training.save_model(model, str(tmp_path), spark, "20200101_000000")
    path = training.save_model(model, str(tmp_path), spark, "20200101_000001")
    again = training.load_model(str(tmp_path), spark)
    a = {r["customer_id"]: r["churn_probability"] for r in training.score(model, test).collect()}
    b = {r["customer_id"]: r["churn_probability"] for r in training.score(again, test).collect()}
    assert a == b and path.endswith("000001")


def test_linear_explanation_adds_up_to_the_margin(compared):
    train, test, c = compared
    prepared = training.prepare_training(train, LABEL, ["customer_id"])
    model = training.fit_model(prepared, "LogisticRegression")
    parts = explain.linear_contributions(model, prepared.preparation, test, train, "customer_id")
    sums = parts.groupBy("customer_id").agg(F.sum("contribution").alias("s"))
    raw = model.transform(test).select("customer_id", F.udf(lambda v: float(v[1]), "double")("rawPrediction").alias("m"))
    diffs = [r["m"] - r["s"] for r in sums.join(raw, "customer_id").collect()]
    assert max(diffs) - min(diffs) < 1e-6


def test_shapley_paths_add_up(compared):
    train, test, c = compared
    prepared = training.prepare_training(train, LABEL, ["customer_id"])
    model = training.fit_model(prepared, "RandomForest", {"n_estimators": 5, "max_depth": 4})
    names = prepared.preparation.numeric[:12] + prepared.preparation.categorical[:3]
    names = [n for n in names if n in test.columns]
    rows = test.orderBy("customer_id").limit(3)
    out = explain.sampled_shapley(model, prepared.preparation, rows, "customer_id", names, permutations=4)
    assert out.count() == 3 * len(names)
    sums = {r["customer_id"]: r["s"] for r in out.groupBy("customer_id").agg(F.sum("contribution").alias("s")).collect()}
    score = {r["customer_id"]: r["churn_probability"] for r in training.score(model, rows).collect()}
    base = {round(score[i] - sums[i], 6) for i in sums}
    assert len(base) == 1


def test_grids_have_all_combinations():
    assert [len(training.grid(k)) for k in training.MODEL_TYPES] == [5, 72, 81]


def test_grid_search_picks_the_best(compared):
    train, _, _ = compared
    tuned = training.grid_search(train, LABEL, "customer_id", "LogisticRegression", ["customer_id"], folds=2,
                                 combos=[{"C": 1e-6}, {"C": 1.0}])
    rows = tuned.results.collect()
    assert sum(r["best"] for r in rows) == 1
    assert tuned.params == [{"C": 1e-6}, {"C": 1.0}][max(range(2), key=lambda i: (rows[i]["mean_roc_auc"], -i))]


def test_grid_search_over_numbers_of_trees(compared):
    train, _, _ = compared
    combos = [{"n_estimators": n, "max_depth": d} for n in (1, 4) for d in (1, 3)]
    rows = training.grid_search(train, LABEL, "customer_id", "GradientBoosting", ["customer_id"], folds=2, combos=combos).results.collect()
    assert [r["params"] for r in sorted(rows, key=lambda r: r["ordinal"])] == [str(c) for c in combos]
    by = {r["ordinal"]: r["mean_roc_auc"] for r in rows}
    assert by[3] > by[0] > 0.5 and sum(r["best"] for r in rows) == 1


def test_unknown_model_type():
    with pytest.raises(ValueError):
        training.classifier("Nope", "y", 1.0)


def test_whole_run(spark, data, tmp_path, monkeypatch):
    monkeypatch.setattr(training, "MODEL_TYPES", ["LogisticRegression"])
    run = run_risk_pipeline(spark, data, str(tmp_path), LABEL)
    assert sum(r["customers"] for r in run.distribution.collect()) <= 150
    assert run.quality.count() > 0 and run.explanations.count() == 5
    assert len(run.explanations.first()["top_factors"]) == 5
    assert spark.read.csv(run.predictions_path, header=True).count() == 150
    meta = spark.read.json(f"{tmp_path}/model_metadata").first()
    assert meta["model_type"] == run.best


def test_failing_exploration_is_only_a_warning(spark, data, tmp_path, monkeypatch):
    from tallywell.plans import pipeline

    def broken(*a):
        raise RuntimeError("no")

    monkeypatch.setattr(pipeline, "explore", broken)
    monkeypatch.setattr(pipeline.training, "compare_models", lambda *a, **k: (_ for _ in ()).throw(KeyError("stop")))
    with pytest.raises(KeyError):
        run_risk_pipeline(spark, data, str(tmp_path), LABEL)


def test_grids_nest_by_number_of_trees():
    assert [len(training.nested(training.grid(k))) for k in training.MODEL_TYPES] == [5, 24, 27]
    for kind in training.MODEL_TYPES:
        combos = training.grid(kind)
        for largest, sizes in training.nested(combos):
            for trees, i in sizes.items():
                assert combos[i] == ({**largest, "n_estimators": trees} if trees else largest)
    assert {i for _, sizes in training.nested(training.grid("RandomForest")) for i in sizes.values()} == set(range(72))


@pytest.fixture(scope="module")
def points(spark):
    rows = [(float((i * 7919) % 101), float((i * 104729) % 89), float(i % 3)) for i in range(240)]
    made = spark.createDataFrame([(*r, float(r[0] + 20 * r[2] + (i % 17) > 70), 1.0) for i, r in enumerate(rows)],
                                 "a double, b double, c double, y double, weight double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(made).select("features", "y", "weight")


def test_first_boosted_trees_are_the_smaller_model(points):
    common = {"max_depth": 3, "learning_rate": 0.2, "subsample": 0.8}
    large = training.classifier("GradientBoosting", "y", 240.0, {**common, "n_estimators": 7}).fit(points)
    for trees in (2, 5):
        small = training.classifier("GradientBoosting", "y", 240.0, {**common, "n_estimators": trees}).fit(points)
        cut = training.first_trees(large, trees)
        assert cut.getNumTrees == trees
        a, b = ([r.probability[1] for r in m.transform(points).collect()] for m in (cut, small))
        assert a == pytest.approx(b, abs=1e-12)


def test_first_forest_trees_are_the_mean_of_those_trees(points):
    large = training.classifier("RandomForest", "y", 240.0, {"n_estimators": 6, "max_depth": 4}).fit(points)
    cut = training.first_trees(large, 3)
    trees = [[r.probability[1] for r in t.transform(points).collect()] for t in large.trees[:3]]
    got = [r.probability[1] for r in cut.transform(points).collect()]
    assert got == pytest.approx([sum(p) / 3 for p in zip(*trees)], abs=1e-12)
    assert training.first_trees(large, 6) is large and training.first_trees(large, 0) is large
