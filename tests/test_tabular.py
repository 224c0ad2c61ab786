"""Hand-worked edges of the tabular operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tallywell.operators import explain, features, metrics, prep, profile, ranking, risk, split
from tallywell.operators.quantiles import exact_quantiles
from tallywell.session import shared_dir, staged
from tallywell.sources import tables


def values(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_risk_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.3,), (0.300001,), (0.7,), (1.0,), (None,)], "p double")
    got = [r["risk_category"] for r in risk.with_risk(df, "p").collect()]
    assert got == [None, "Low Risk", "Medium Risk", "Medium Risk", "High Risk", None]


def test_tenure_edges(spark):
    df = spark.createDataFrame([(t,) for t in (0, 6, 7, 12, 24, 36, 37, None)], "tenure int")
    got = [r["tenure_group"] for r in features.engineer_features(df).collect()]
    assert got == [None, "0-6 months", "6-12 months", "6-12 months", "1-2 years", "2-3 years", "3+ years", None]


def test_features_only_where_inputs_exist(spark):
    df = spark.createDataFrame([(1, 2)], "service_a int, other int")
    assert features.engineer_features(df).columns == ["service_a", "other"]
    df = spark.createDataFrame([(1, None, 0, 0.0)], "service_a int, service_b int, tenure int, support_calls double")
    row = features.engineer_features(df).first()
    assert row["total_services"] == 1 and row["support_calls_per_month"] is None


def test_feature_types_skip_bool_and_date(spark):
    df = spark.sql("SELECT 1 AS a, 1.5D AS b, 'x' AS c, true AS d, current_date() AS e, 0 AS y, 7 AS id")
    assert features.feature_types(df, "y", ["id"]) == (["a", "b"], ["c"])


def test_split_target_absent(spark):
    df = spark.range(2)
    x, y = features.split_target(df, "Churn")
    assert y is None and x.columns == ["id"]


def test_lump_other(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), (None,)], "v string")
    got = sorted(r["v"] for r in features.lump_other(df, "v", keep=2).collect())
    assert got == ["Other", "Other", "a", "a", "a", "b", "b"]
    unchanged = [r["v"] for r in features.lump_other(df, "v", keep=3).collect()]
    assert unchanged.count(None) == 1 and "c" in unchanged


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(1.0, 1.0, 2.0), (2.0, 1.0, 4.0), (3.0, 1.0, 6.0)], "a double, k double, b double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df, ["a", "k", "b"]).collect()}
    assert got == {("k", "a"): None, ("b", "a"): 1.0, ("b", "k"): None}


def test_all_null_column(spark):
    df = spark.createDataFrame([(None, "x"), (None, "x")], "a double, c string")
    assert profile.dq_imbalanced(df, ["c"]).count() == 1
    empty = df.withColumn("c", F.lit(None).cast("string"))
    assert profile.dq_imbalanced(empty, ["c"]).count() == 0
    row = profile.profile_numeric(df, ["a"]).first()
    assert row["n"] == 0 and row["p50"] is None
    assert profile.dq_outliers_iqr(df.withColumn("b", F.lit(1.0)), ["a", "b"]).count() == 0


def test_quantiles_interpolate(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert exact_quantiles(df, {"x": F.col("x")}, [0.5]) == {"x": [2.5]}


@pytest.mark.parametrize("shape", ["uniform", "skewed", "ties"])
def test_quantiles_by_narrowing_equal_sorting(spark, shape):
    rng = random.Random(7)
    xs = {"uniform": [rng.random() for _ in range(20000)],
          "skewed": [rng.random() ** 9 * 1e6 for _ in range(20000)],
          "ties": [float(rng.choice([1, 1, 1, 2, 5])) for _ in range(20000)]}[shape]
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(7)
    probs = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, {"x": F.col("x")}, probs, limit=50)["x"]
    xs.sort()
    for p, g in zip(probs, got):
        pos = (len(xs) - 1) * p
        lo = math.floor(pos)
        hi = min(lo + 1, len(xs) - 1)
        assert g == pytest.approx(xs[lo] + (xs[hi] - xs[lo]) * (pos - lo), rel=1e-9)


def test_nan_is_missing(spark):
    df = tables.nan_to_null(spark.createDataFrame([(float("nan"),), (1.0,)], "x double"))
    assert profile.profile_missing(df).first()["missing"] == 1


def test_roc_and_pr_with_ties(spark):
    rows = list(zip([.9, .8, .7, .7, .2, .1], [1, 0, 1, 0, 0, 1]))
    df = spark.createDataFrame(rows, "s double, y int")
    assert metrics.roc_auc(df, "y", "s").first()[0] == pytest.approx(0.5)
    assert metrics.pr_auc(df, "y", "s").first()[0] == pytest.approx(0.65)
    assert metrics.roc_curve(df, "y", "s").count() == 6
    out = metrics.evaluate(df.withColumn("p", (F.col("s") > 0.5).cast("int")), "y", "p", "s")
    assert out["roc_auc"] == pytest.approx(0.5) and out["accuracy"] == pytest.approx(0.5)


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    assert metrics.classification_metrics(df, "y", "p").first().asDict() == {
        "accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1_score": 0.0}


def test_running_totals_equal_plain_sums(spark, monkeypatch):
    monkeypatch.setattr(ranking, "RUNNING_BUCKETS", 16)
    rng = random.Random(3)
    xs = sorted({rng.random() ** 5 for _ in range(500)}, reverse=True)
    df = spark.createDataFrame([(x, i % 3) for i, x in enumerate(xs)], "x double, w int")
    got = {r["x"]: r["cum_w"] for r in ranking.running_totals(df, "x", ["w"]).collect()}
    total = 0
    for i, x in enumerate(xs):
        total += i % 3
        assert got[x] == total


def test_split_and_folds_do_not_depend_on_partitions(spark):
    df = spark.range(1003).select(F.col("id"), (F.col("id") % 7 == 0).cast("int").alias("y"))
    one = {r["id"] for r in split.stratified_split(df, "y", "id").filter("is_test").collect()}
    two = {r["id"] for r in split.stratified_split(df.repartition(13), "y", "id").filter("is_test").collect()}
    assert one == two
    n1 = df.filter("y = 1").count()
    assert sum(1 for i in one if i % 7 == 0) == round(.2 * n1)
    folds = split.stratified_kfold(df, "y", "id").groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in folds if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    assert split.simple_split(df, "id").filter("is_test").count() == 201


def test_split_of_a_tiny_class(spark):
    df = spark.createDataFrame([(i, 1 if i < 2 else 0) for i in range(20)], "id long, y int")
    out = split.stratified_split(df, "y", "id")
    assert out.count() == 20
    assert out.filter("is_test and y = 1").count() == 0
    assert split.stratified_kfold(df, "y", "id").count() == 20


def test_mode_tie_and_imputation(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,)], "c string")
    assert prep.modes(df, ["c"]) == {"c": "a"}
    assert prep.impute_mode(df, {"c": "a"}).filter("c = 'a'").count() == 3


def test_unseen_category_is_all_zero_and_survives_saving(spark, tmp_path):
    from pyspark.ml import PipelineModel
    train = spark.createDataFrame([(1.0, "a", 0), (3.0, "b", 1), (None, "it's", 0)], "x double, c string, y int")
    fitted = prep.fit_preparation(train, "y")
    assert fitted.slots == ["x", "c=a", "c=b", "c=it's"]
    new = spark.createDataFrame([(2.0, "z"), (None, None)], "x double, c string")
    path = str(tmp_path / "prep")
    fitted.model().write().overwrite().save(path)
    for model in (fitted.model(), PipelineModel.load(path)):
        rows = [list(r["features"].toArray()) for r in model.transform(new).collect()]
        assert rows[0][1:] == [0, 0, 0] and rows[0][0] == pytest.approx(0.0)
        assert rows[1] == pytest.approx([0.0, 1, 0, 0])


def test_constant_numeric_is_not_divided_by_zero(spark):
    df = spark.createDataFrame([(5.0, 0), (5.0, 1)], "x double, y int")
    assert [list(r["features"].toArray()) for r in prep.fit_preparation(df, "y").transform(df).collect()] == [[0.0], [0.0]]


def test_contributions_add_up_to_the_score(spark):
    df = spark.createDataFrame([(1, "Monthly", 3, 30, 1, 0, 1, 0, 2), (2, "Annual", 0, 3, 0, 0, 0, 0, 0)],
                               "customer_id int, contract_type string, support_calls int, tenure int, service_click int,"
                               "service_view int, service_purchase int, service_signup int, late_payments int")
    terms = explain.centred_terms(df, risk.rule_terms())
    scored = df.withColumn("s", risk.rule_score())
    mean = scored.agg(F.avg("s")).first()[0]
    sums = explain.long_contributions(scored, terms, "customer_id", "s").groupBy("customer_id", "s").sum("contribution")
    for r in sums.collect():
        assert r[2] == pytest.approx(r["s"] - mean, abs=1e-5)


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok', None), (2, "b", 1.5)], "id int, t string, x double")
    path = tables.write_csv(df, str(tmp_path / "t.csv"))
    assert sorted(values(tables.load_table(spark, path, df.schema), "id", "t", "x")) == [(1, 'say "hi", ok', None), (2, "b", 1.5)]
    inferred = tables.load_table(spark, path)
    assert dict(inferred.dtypes)["id"] == "bigint" and dict(inferred.dtypes)["x"] == "double"


def test_csv_keeps_line_breaks_empty_texts_and_missing_values_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, ""), (3, None), (4, 'q"\\')], "id bigint, t string")
    path = tables.write_csv(df, str(tmp_path / "t.csv"))
    for schema in (df.schema, None):
        assert sorted(values(tables.load_table(spark, path, schema, "csv"), "id", "t"), key=lambda r: r[0]) == [
            (1, "a\nb"), (2, ""), (3, None), (4, 'q"\\')]


def test_csv_missing_words_and_types(spark, tmp_path):
    (tmp_path / "m.csv").write_text('n,x,c,b,a.b\n1,NA,"two\nlines",true,1\n,2.5,NULL,False,\n3,nan,z,NA,2\n')
    df = tables.load_table(spark, str(tmp_path / "m.csv"))
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "c": "string", "b": "boolean", "a.b": "bigint"}
    assert [tuple(r) for r in df.orderBy(F.col("n").asc_nulls_last()).collect()] == [
        (1, None, "two\nlines", True, 1), (3, None, "z", None, 2), (None, 2.5, None, False, None)]
    kept = tables.load_table(spark, str(tmp_path / "m.csv"), missing=())
    assert dict(kept.dtypes)["x"] == "string"


def test_correlation_with_many_patterns_of_missing_values(spark):
    import numpy as np
    x = np.random.default_rng(1).normal(size=(300, 4))
    gone = np.random.default_rng(2).random(x.shape) < 0.4
    rows = [tuple(None if g else float(v) for v, g in zip(r, m)) for r, m in zip(x, gone)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(3)
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.correlation_matrix(df, ["a", "b", "c", "d"]).collect()}
    for i in range(4):
        for j in range(i + 1, 4):
            both = ~gone[:, i] & ~gone[:, j]
            assert got["abcd"[j], "abcd"[i]] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-6)


def test_dominant_value_by_bit_majority(spark):
    df = spark.createDataFrame([("x", "p", None)] * 19 + [("y", "q", None), ("z", "p", "v")], "a string, b string, c string")
    got = {r["column_name"]: (r["dominant_value"], r["dominant_pct"]) for r in profile.dq_imbalanced(df, ["a", "b", "c"]).collect()}
    assert got == {"a": ("x", pytest.approx(1900 / 21, abs=1e-6)), "b": ("p", pytest.approx(2000 / 21, abs=1e-6)), "c": ("v", 100.0)}


def test_factors_of_a_row_need_no_shuffle(spark):
    df = spark.createDataFrame([(1, 3.0, -5.0, None), (2, 1.0, 1.0, 0.0)], "id long, x double, y double, z double")
    found = explain.top_factors(df, {c: F.col(c) for c in "xyz"}, "id", k=2)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(tuple(r) for r in found.select("id", "rank", "feature").collect()) == [
        (1, 1, "y"), (1, 2, "x"), (2, 1, "x"), (2, 2, "y")]


def test_too_many_categories_are_named(spark):
    df = spark.range(300).select(F.col("id").cast("string").alias("text"), F.lit("a").alias("c"))
    prep.check_categories(df, ["c"], 100)
    with pytest.raises(ValueError, match="text"):
        prep.check_categories(df, ["c", "text"], 100)


def test_staged_tables_lie_in_the_shared_folder(spark):
    df = staged(spark.range(5))
    assert df.count() == 5 and shared_dir(spark) in df.inputFiles()[0]


def test_summary_has_every_section(spark):
    df = spark.createDataFrame([(1, 2.0, "a", 0), (2, None, None, 1)], "id int, x double, c string, y int")
    rows = profile.data_summary(df, "y", ["id"]).collect()
    assert {r["section"] for r in rows} == {"shape", "missing", "target", "numeric", "categorical"}
    got = {(r["section"], r["column_name"], r["metric"]): r["value"] for r in rows}
    assert got["missing", "x", "missing_pct"] == "50.0" and got["target", "1", "n"] == "1"


def test_column_names_with_dots(spark):
    df = spark.createDataFrame([(1.0, "x", 0), (2.0, None, 1), (None, "x", 1), (9.0, "y", 0)], "`a.b` double, `c.d` string, `y.z` int")
    assert {r["column_name"] for r in profile.profile_missing(df).collect()} == {"a.b", "c.d", "y.z"}
    assert profile.profile_numeric(df, ["a.b"]).first()["p50"] == 2.0
    assert profile.profile_categorical(df, ["c.d"]).count() == 2
    assert {r["column_name"] for r in profile.data_summary(df, "y.z").collect()} >= {"a.b", "c.d"}
    assert profile.dq_report(df, "y.z").count() > 0
    assert profile.correlation_matrix(df, ["a.b", "y.z"]).count() == 1
    assert prep.medians(df, ["a.b"]) == {"a.b": 2.0}
