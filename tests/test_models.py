"""Encoders, classifiers, validation and the training flow."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from conftest import FOLDER
from larkspur.operators import models, validation
from larkspur.operators.encode import Preprocessor, most_frequent
from larkspur.operators.models import (
    CLASSIFIERS,
    ModelFolder,
    ModelPlan,
    create_classifier,
    feature_importance,
)
from larkspur.operators.splits import random_split
from larkspur.plans import training
from larkspur.plans.queries.models import orders_with_label
from larkspur.plans.registry import Tables
from larkspur.workspace import new_path, scratch_database

PREPARATION = Preprocessor(numeric=["x", "z"], categorical=["kind"], drop=["rest"])


@pytest.fixture(scope="module")
def rows(spark):
    """x decides the label, z is noise, kind has a quote in one category."""
    return spark.range(400).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"),
        (F.xxhash64("id") % 100 / 10.0).alias("x"),
        (F.xxhash64("id", F.lit(1)) % 100 / 10.0).alias("z"),
        F.when(F.col("id") % 3 == 0, "it's").otherwise("other").alias("kind"),
        (F.xxhash64("id") % 100 > 20).cast("int").alias("y"),
    )


def test_all_null_column_and_nulls(spark):
    rows = spark.createDataFrame([(1.0, None, "a"), (3.0, None, None), (None, None, "a")], "x double, e double, c string")
    fitted = Preprocessor(numeric=["x", "e"], categorical=["c"], drop=["rest"]).fit(rows)
    got = fitted.transform(rows).collect()
    assert [r["num__x"] for r in got] == pytest.approx([-np.sqrt(1.5), np.sqrt(1.5), 0.0])
    assert [r["cat__c_a"] for r in got] == [1.0, 1.0, 1.0]


def test_nan_is_imputed(spark):
    rows = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "x double")
    for strategy in ("standard", "robust"):
        fitted = Preprocessor(numeric=["x"], numeric_strategy=strategy, missing_strategy="median").fit(rows)
        assert [r[0] for r in fitted.transform(rows).collect()][2] == 0.0


def test_constant_column_is_not_divided_by_zero(spark):
    rows = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    for strategy in ("standard", "minmax", "robust"):
        fitted = Preprocessor(numeric=["x"], numeric_strategy=strategy).fit(rows)
        assert {r["num__x"] for r in fitted.transform(rows).collect()} == {0.0}


def test_null_category_without_imputing(spark):
    rows = spark.createDataFrame([("b",), (None,), ("a",)], "c string")
    flags = Preprocessor(categorical=["c"], missing_strategy="none").fit(rows)
    assert flags.names == ["cat__c_a", "cat__c_b", "cat__c_None"]
    codes = Preprocessor(categorical=["c"], categorical_strategy="ordinal", missing_strategy="none").fit(rows)
    assert [r[0] for r in codes.transform(rows).collect()] == [1.0, None, 0.0]


def test_numeric_categories_sort_as_numbers(spark):
    rows = spark.createDataFrame([(10,), (9,), (9,)], "c int")
    codes = Preprocessor(categorical=["c"], categorical_strategy="ordinal").fit(rows).transform(rows)
    assert [r[0] for r in codes.collect()] == [1.0, 0.0, 0.0]
    assert most_frequent(rows.union(rows.where("c = 10")), ["c"]) == {"c": "9"}


def test_no_listed_column_passes_everything_through(spark):
    rows = spark.createDataFrame([(1, "a")], "x int, c string")
    assert Preprocessor().fit(rows).transform(rows).first().asDict() == {"x": 1, "c": "a"}


def test_unknown_strategies_raise():
    for name in ("numeric_strategy", "categorical_strategy", "missing_strategy"):
        with pytest.raises(ValueError, match="Unknown"):
            Preprocessor(**{name: "fancy"})


@pytest.mark.parametrize("missing", ["mean", "none"])
def test_dictionaries_give_what_expressions_give(spark, missing):
    """Text and number categories, nulls, a commonest value, unknown values: codes and vectors as by expressions."""
    data = spark.range(300).select(
        "id",
        F.when(F.col("id") % 11 != 0, F.concat(F.lit("v'"), (F.col("id") % 40).cast("string"))).alias("a"),
        (F.col("id") % 25).cast("int").alias("b"),
        (F.col("id") % 3).cast("string").alias("few"),
    )
    new = data.unionByName(spark.createDataFrame([(900, "new", 999, "9"), (901, None, None, None)], data.schema))
    for strategy in ("ordinal", "onehot"):
        options = {"categorical": ["a", "b", "few"], "categorical_strategy": strategy, "missing_strategy": missing}
        small, large = (Preprocessor(**options, drop=["id"], max_categories=n).fit(data) for n in (10_000, 10))
        assert [d.column for d in large.dictionaries] == ["a", "b"]
        want = {r["id"]: r for r in small.transform(new, ["id"]).collect()}
        for r in large.transform(new, ["id"]).collect():
            for c in "ab":
                if strategy == "ordinal":
                    assert r[f"cat__{c}"] == want[r["id"]][f"cat__{c}"]
                else:
                    flags = [v for name, v in want[r["id"]].asDict().items() if name.startswith(f"cat__{c}_")]
                    assert list(r[f"cat__{c}"].toArray()) == flags
            assert r["cat__few"] == want[r["id"]]["cat__few"] if strategy == "ordinal" else r["cat__few_2"] is not None
    named = large.flags(new, "b", ["7", "24"], ["id"])
    assert named.columns == ["id", "cat__b_7", "cat__b_24"] and named.where("cat__b_7 = 1").count() == 12


def test_a_model_keeps_its_dictionary(spark):
    data = spark.range(60_000).select("id", (F.col("id") % 15_000).cast("string").alias("c"), (F.col("id") % 2).cast("int").alias("y"))
    plan = ModelPlan("logistic", Preprocessor(categorical=["c"], drop=["rest"]), {"max_iter": 3})
    model = plan.fit(data, "y", ["id"])
    assert model.score(data).where("prediction = y").count() == 60_000
    top = feature_importance(spark, model, 2)
    assert [r["feature"].startswith("cat__c[") for r in top.collect()] == [True, True] and len(model.feature_names()) == 15_000
    folder = ModelFolder(spark, new_path(spark, "models"))
    folder.register(model)
    assert folder.load().score(data.limit(500)).where("prediction = y").count() == 500
    statement = next(s for s in folder.load().spark_model.stages if hasattr(s, "getStatement")).getStatement()
    assert folder.path in statement


def test_fits_on_unions_of_parts(spark, rows):
    """From one pass what separate fits give, and separate fits where quantiles are asked for."""
    parts = rows.withColumn("part", (F.xxhash64("key", F.lit(5)) % 4 + 3).cast("int") % 4)
    parts = parts.withColumn("x", F.when(F.col("part") != 2, F.col("x"))).cache()
    unions = [{0}, {0, 1}, {0, 1, 2, 3}, {2}]
    for options in ({}, {"numeric_strategy": "minmax", "missing_strategy": "constant"}, {"numeric_strategy": "robust"}):
        spec = Preprocessor(numeric=["x", "z"], categorical=["kind"], drop=["rest"], **options)
        for union, fitted in zip(unions, spec.fit_unions(parts, "part", unions, ["key", "y"]), strict=True):
            own = parts.where(F.col("part").isin(*union))
            alone = spec.fit(own, ["key", "y"])
            assert fitted.names == alone.names
            got, want = (f.transform(own, ["key"]).orderBy("key").collect() for f in (fitted, alone))
            for g, w in zip(got, want, strict=True):
                assert [v for v in g[1:] if v is not None] == pytest.approx([v for v in w[1:] if v is not None])


def test_composite_keys(spark, rows):
    two = rows.withColumn("part", F.length("key")).withColumn("y", (F.col("x") > 8).cast("int"))
    spec = Preprocessor(numeric=["x", "z"], drop=["rest"])
    balanced = ModelPlan("logistic", spec, resampling="smote").fit(two, "y", ["key", "part"])
    assert balanced.score(two).where("prediction = y").count() > 350
    near = ModelPlan("knn", spec).fit(two, "y", ["key", "part"]).score(two, ["key", "part"])
    assert near.columns[: len(two.columns)] == two.columns and near.where("prediction = y").count() > 350


def test_importances_of_one_model_per_class(spark, rows):
    three = rows.withColumn("y", F.when(F.col("x") > 5, 2).otherwise(F.col("y")))
    for name in ("lightgbm", "svm"):
        params = {"n_estimators": 2, "max_depth": 3} if name == "lightgbm" else {"max_iter": 5}
        model = ModelPlan(name, PREPARATION, params).fit(three, "y", ["key"])
        got = feature_importance(spark, model).collect()
        assert len(got) == 4 and got[0]["feature"] == "num__x"


def test_approximate_medians(rows):
    exact = Preprocessor(numeric=["x"], numeric_strategy="robust", drop=["r"]).fit(rows)
    sketch = Preprocessor(numeric=["x"], numeric_strategy="robust", drop=["r"], approximate=True).fit(rows)
    a, b = (f.transform(rows).agg(F.avg("num__x")).first()[0] for f in (exact, sketch))
    assert a == pytest.approx(b, abs=0.05)


def test_classifier_names(spark):
    assert set(CLASSIFIERS) == {
        *("random_forest", "logistic", "gradient_boosting", "decision_tree", "svm"),
        *("knn", "naive_bayes", "lightgbm", "xgboost", "catboost"),
    }
    boosted = create_classifier("lightgbm", n_estimators=300, max_depth=6, learning_rate=0.01, random_state=42)
    got = (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize(), boosted.getSeed())
    assert got == (300, 6, 0.01, 42)
    for bad in ({"model": "oracle"}, {"model": "logistic", "task": "regression"}):
        with pytest.raises(ValueError, match="classifi"):
            create_classifier(bad["model"], bad.get("task", "classification"))
    with pytest.raises(ValueError, match="no parameter"):
        create_classifier("logistic", leaves=3)
    with pytest.raises(ValueError, match="var_smoothing"):
        create_classifier("naive_bayes", var_smoothing=1e-9)
    with pytest.raises(ValueError, match="resampling"):
        ModelPlan("logistic", PREPARATION, resampling="adasyn")


def test_importance_names_every_flag(spark, rows):
    model = ModelPlan("random_forest", PREPARATION, {"n_estimators": 3, "random_state": 1}).fit(rows, "y", ["key"])
    got = feature_importance(spark, model).collect()
    assert {r["feature"] for r in got} == {"num__x", "num__z", "cat__kind_it's", "cat__kind_other"}
    assert got[0]["feature"] == "num__x"


def test_saved_models(spark, rows):
    folder = ModelFolder(spark, new_path(spark, "models"))
    with pytest.raises(LookupError):
        folder.load()
    for version, name in enumerate(("decision_tree", "knn"), start=1):
        model = ModelPlan(name, PREPARATION).fit(rows, "y", ["key"])
        assert folder.register(model) == version
        want, got = (sorted((r["key"], r["prediction"]) for r in m.score(rows, ["key"]).collect()) for m in (model, folder.load()))
        assert got == want
    assert folder.load(1).classifier.numNodes > 1


def test_boosting_with_three_classes(rows):
    three = rows.withColumn("y", F.when(F.col("x") > 5, 2).otherwise(F.col("y")))
    model = ModelPlan("lightgbm", PREPARATION, {"n_estimators": 2, "max_depth": 3}).fit(three, "y", ["key"])
    got = model.score(three)
    assert got.where("y = prediction").count() > 300
    assert got.where("probability IS NOT NULL").count() == 0


def test_cross_validation(rows):
    got = {r["metric"]: r for r in validation.cross_validate(ModelPlan("decision_tree", PREPARATION), rows, "y", ["key"], 3).collect()}
    assert set(got) == set(validation.CLASSIFICATION)
    assert got["accuracy"]["mean"] > 0.95
    assert len(got["accuracy"]["values"]) == 3
    assert got["accuracy"]["std"] == pytest.approx(np.std(got["accuracy"]["values"]))


def test_learning_curve(rows):
    plan = ModelPlan("decision_tree", PREPARATION)
    got = validation.learning_curve(plan, rows, "y", ["key"], cv=2, train_sizes=[0.5, 1.0]).orderBy("share").collect()
    assert [r["share"] for r in got] == [0.5, 1.0]
    assert got[0]["train_rows"] < got[1]["train_rows"] <= 201
    assert got[1]["test_mean"] > 0.9


def test_training_flow_promotes_once(spark, rows):
    train, test = random_split(rows, ["key"], 0.25)
    job = training.TrainingJob(
        spark,
        f"{scratch_database(spark)}.features",
        ModelFolder(spark, new_path(spark, "models")),
        ModelPlan("decision_tree", PREPARATION),
        ["key"],
        "y",
    )
    first, second = (job.run(train, test).first() for _ in range(2))
    assert (first["improved"], first["version"]) == (True, 1)
    assert (second["improved"], second["version"]) == (False, 1)
    assert second["champion_f1"] == second["challenger_f1"]


def test_logistic_penalty_is_against_the_sum_of_losses(spark):
    """One column, one weight: the minimum of C * sum of losses + w^2 / 2 is found by bisection of its slope."""
    import math

    rows = spark.range(400).select("id", (F.col("id") % 20 / 10.0 - 1.0).alias("x"))
    rows = rows.withColumn("label", ((F.col("x") + (F.col("id") % 7 - 3) / 4.0) > 0).cast("int"))
    data = [(r["x"], r["label"]) for r in rows.collect()]

    def slope(w, c):
        return w + c * sum(x * (1 / (1 + math.exp(-w * x)) - y) for x, y in data)

    for c in (1.0, 0.05):
        low, high = 0.0, 50.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (low, middle) if slope(middle, c) > 0 else (middle, high)
        params = {"C": c, "fit_intercept": False, "max_iter": 200, "tol": 1e-10}
        plan = ModelPlan("logistic", Preprocessor(numeric=["x"], numeric_strategy="none", missing_strategy="none"), params)
        fitted = plan.fit(rows, "label", ["id"]).classifier
        assert fitted.coefficients[0] == pytest.approx(low, rel=1e-4)


@pytest.mark.parametrize("name", ["score_batch", "fit_random_forest", "fit_gradient_boosting", "fit_naive_bayes", "fit_svm", "fit_balanced_smote"])
def test_results_of_fits(spark, name):
    """A prediction is the likelier class, every test row has one, and the model beats the commoner class."""
    got = queries()[name](spark, FOLDER).collect()
    wanted = {r[0] for r in random_split(orders_with_label(Tables(spark, FOLDER)), ["o_orderkey"])[1].select("o_orderkey").collect()}
    assert {r["o_orderkey"] for r in got} == wanted and len(got) == len(wanted)
    for r in got:
        assert r["prediction"] in (0.0, 1.0)
        assert r["probability"] is None or abs(r["probability"] - 0.5) < 1e-6 or r["prediction"] == (r["probability"] > 0.5)
    right = np.mean([r["prediction"] == r["label"] for r in got])
    positive = np.mean([r["label"] for r in got])
    assert right > max(positive, 1 - positive) or (name == "fit_svm" and right == 1 - positive)


def test_importances_and_curves(spark):
    whole = queries()["feature_importance"](spark, FOLDER).collect()
    assert whole[0]["feature"] == "num__o_totalprice" and sum(r["importance"] for r in whole) == pytest.approx(1)
    assert [r["importance"] for r in whole] == sorted((r["importance"] for r in whole), reverse=True) and len(whole) == 14
    folds = {r["metric"]: r for r in queries()["cross_validate"](spark, FOLDER).collect()}
    assert len(folds["accuracy"]["values"]) == 5 and 0.9 < folds["accuracy"]["mean"] <= 1
    first, second = queries()["train_and_promote"](spark, FOLDER).orderBy("run").collect()
    assert (first["improved"], first["version"], second["improved"], second["version"]) == (True, 1, False, 1)
    assert second["champion_f1"] == second["challenger_f1"] == first["challenger_f1"] and first["accuracy"] > 0.9

def test_a_fit_reads_rows_on_all_cores(spark, monkeypatch):
    """However few files the rows lie in: one task would do all passes of hundreds of trees."""
    parts = []

    class Recorded:
        def fit(self, training):
            parts.append([len(p) for p in training.rdd.glom().collect()])
            raise InterruptedError

    monkeypatch.setattr(models, "create_classifier", lambda *a, **k: Recorded())
    rows = spark.range(0, 40_000, 1, 1).select("id", F.rand(1).alias("x"), (F.col("id") % 2).alias("y"))
    with pytest.raises(InterruptedError):
        ModelPlan("lightgbm", Preprocessor(numeric=["x"])).fit(rows, "y", ["id"])
    cores = spark.sparkContext.defaultParallelism
    assert len(parts[0]) == min(cores, 5) and sum(parts[0]) == 40_000
    assert max(parts[0]) <= 2 * min(parts[0])


def test_models_share_folds_and_orders_are_joined_once(t, monkeypatch):
    """compare_models deals the folds once for all models, and what it reads again and again is a stored table."""
    rows = orders_with_label(t)
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()
    calls = []
    dealt = validation.with_fold
    monkeypatch.setattr(validation, "with_fold", lambda *a: calls.append(a) or dealt(*a))
    preparation = Preprocessor(numeric=["o_totalprice", "order_year"], drop=["rest"])
    plans = [(n, ModelPlan("decision_tree", preparation, {"max_depth": d})) for n, d in (("low", 1), ("high", 3))]
    got = {r["model"]: r for r in validation.compare_models(plans, rows, "label", ["o_orderkey"], cv=2).collect()}
    assert len(calls) == 1 and set(got) == {"low", "high"}
    for name, plan in plans:
        alone = {r["metric"]: r for r in validation.cross_validate(plan, rows, "label", ["o_orderkey"], cv=2).collect()}
        for metric, r in alone.items():
            assert abs(got[name][f"{metric}_mean"] - r["mean"]) < 1e-9 and abs(got[name][f"{metric}_std"] - r["std"]) < 1e-9


def test_learning_curve_keeps_counts_not_rows(t, monkeypatch):
    """Predictions are stored as rows per label and prediction; an area still looks at each score."""
    stored = []
    written = validation.materialize
    monkeypatch.setattr(validation, "materialize", lambda df, label: stored.append((label, df.columns)) or written(df, label))
    rows = orders_with_label(t)
    plan = ModelPlan("decision_tree", Preprocessor(numeric=["o_totalprice"], drop=["rest"]), {"max_depth": 2})
    curves = {}
    for metric in ("accuracy", "roc_auc"):
        stored.clear()
        found = validation.learning_curve(plan, rows, "label", ["o_orderkey"], cv=2, train_sizes=(0.5, 1.0), metric=metric)
        curves[metric] = {r["share"]: r for r in found.collect()}
        assert all(("_n" in columns) == (metric == "accuracy") for label, columns in stored if label == "predictions")
    # Both ways count the same training rows.
    assert {s: r["train_rows"] for s, r in curves["accuracy"].items()} == {s: r["train_rows"] for s, r in curves["roc_auc"].items()}


def test_rows_are_drawn_before_vectors_are_made(t, monkeypatch):
    from larkspur.operators import models

    seen = []
    drawn = models.over_sample
    monkeypatch.setattr(models, "over_sample", lambda df, *a, **k: seen.append(df.columns) or drawn(df, *a, **k))
    preparation = Preprocessor(numeric=["o_totalprice"], categorical=["o_orderpriority"], drop=["rest"])
    ModelPlan("logistic", preparation, resampling="random_over").fit(orders_with_label(t), "label", ["o_orderkey"])
    assert seen == [["o_orderkey", "label", "o_totalprice", "o_orderpriority", "_label"]]


@pytest.mark.parametrize("name", ["decision_tree", "lightgbm"])
def test_trees_from_counted_rows(spark, monkeypatch, name):
    """Many rows are counted by bins and label before the fit: equal columns give the model of the single rows."""
    rows = spark.range(6_000).select(
        "id",
        (F.xxhash64("id") % 12).cast("double").alias("x"),
        (F.xxhash64("id", F.lit(1)) % 5).cast("double").alias("z"),
        F.when(F.col("id") % 3 == 0, "it's").otherwise("other").alias("kind"),
    )
    rows = rows.withColumn("y", ((F.col("x") + F.col("z") > 3) & (F.xxhash64("id", F.lit(2)) % 10 > 1)).cast("int"))
    params = {"random_state": 1} | ({"n_estimators": 3, "max_depth": 3} if name == "lightgbm" else {})
    plan = ModelPlan(name, PREPARATION, params)
    want = {r["id"]: r for r in plan.fit(rows, "y", ["id"]).score(rows).collect()}
    monkeypatch.setattr(models, "_MANY_ROWS", 1_000)
    trained, grown = [], models.create_classifier

    def create(*a, weightCol=None, **k):
        if weightCol is None:
            return grown(*a, **k)
        classifier = grown(*a, weightCol=weightCol, **k)
        fit = classifier.fit
        monkeypatch.setattr(classifier, "fit", lambda df: trained.append(df.agg(F.count("*"), F.sum(weightCol)).first()) or fit(df), raising=False)
        return classifier

    monkeypatch.setattr(models, "create_classifier", create)
    model = plan.fit(rows, "y", ["id"])
    assert trained[0][0] <= 23 * 9 * 2 * 2 and trained[0][1] == 6_000
    for r in model.score(rows).collect():
        assert r["prediction"] == want[r["id"]]["prediction"] and r["probability"] == pytest.approx(want[r["id"]]["probability"])
    # Drawn rows and least numbers of rows are single rows.
    for one in ({"min_samples_leaf": 5}, *([{"subsample": 0.5}] if name == "lightgbm" else [])):
        ModelPlan(name, PREPARATION, params | one).fit(rows, "y", ["id"])
    assert len(trained) == 1


def test_columns_of_many_values_are_cut_into_bins(spark, monkeypatch):
    """At shares of all rows: few different rows are left, and the model keeps its names and can be saved."""
    monkeypatch.setattr(models, "_MANY_ROWS", 1_000)
    rows = spark.range(20_000).select(
        "id", F.rand(1).alias("x"), (F.rand(2) * 100).alias("z"), F.when(F.col("id") % 2 == 0, "it's").otherwise("other").alias("kind")
    )
    rows = spark.createDataFrame(rows.withColumn("y", (F.col("x") > 0.5).cast("int")).toPandas())
    counted, written = [], models.materialize
    monkeypatch.setattr(models, "materialize", lambda df, label: counted.append((label, written(df, label))) or counted[-1][1])
    model = ModelPlan("decision_tree", PREPARATION, {"random_state": 1}).fit(rows, "y", ["id"])
    table = dict(counted)["counted"]
    assert table.count() <= 2 * 32 * 32 * 2 and table.agg(F.sum("_rows")).first()[0] == 20_000
    assert model.score(rows).where("prediction = y").count() > 19_900
    top = feature_importance(spark, model).collect()
    assert {r["feature"] for r in top} == {"num__x", "num__z", "cat__kind_it's", "cat__kind_other"} and top[0]["feature"] == "num__x"
    folder = ModelFolder(spark, new_path(spark, "models"))
    folder.register(model)
    again = folder.load().score(rows).select("id", F.col("prediction").alias("again"))
    assert model.score(rows).join(again, "id").where("prediction = again").count() == 20_000


def test_a_learning_curve_of_many_rows_keeps_counted_rows(spark, monkeypatch):
    """Whatever the share of rows, a fit keeps the different rows, and the curve is that of single rows."""
    rows = spark.range(4_000).select(
        "id",
        (F.xxhash64("id") % 9).cast("double").alias("x"),
        (F.xxhash64("id", F.lit(1)) % 4).cast("double").alias("z"),
        F.lit("one").alias("kind"),
    )
    rows = rows.withColumn("y", ((F.col("x") + F.col("z") > 2) | (F.xxhash64("id", F.lit(2)) % 9 == 0)).cast("int"))
    plan = ModelPlan("decision_tree", PREPARATION, {"max_depth": 3, "random_state": 1})

    def curve():
        found = validation.learning_curve(plan, rows, "y", ["id"], cv=2, train_sizes=(0.5, 1.0))
        return [v for r in found.orderBy("share").collect() for v in r]

    want = curve()
    monkeypatch.setattr(models, "_MANY_ROWS", 500)
    kept, written = [], models.materialize
    monkeypatch.setattr(models, "materialize", lambda df, label: kept.append((label, written(df, label))) or kept[-1][1])
    assert curve() == pytest.approx(want)
    assert [label for label, _ in kept] == ["counted"] * 4 and all(t.count() <= 17 * 7 * 2 for _, t in kept)
