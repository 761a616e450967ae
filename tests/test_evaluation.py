"""Metrics and curves against Spark's own evaluators."""

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from larkspur.operators import curves, evaluate, validation
from larkspur.plans.inputs import scored


@pytest.fixture(scope="module")
def rows(t):
    return scored(t).withColumns({c: F.col(c).cast("double") for c in ("y", "prediction")}).cache()


def test_weighted_metrics(rows):
    got = evaluate.classification_metrics(rows, "y", "prediction").first()
    for name, metric in (
        ("accuracy", "accuracy"),
        ("precision", "weightedPrecision"),
        ("recall", "weightedRecall"),
        ("f1", "f1"),
    ):
        evaluator = MulticlassClassificationEvaluator(labelCol="y", metricName=metric)
        assert got[name] == pytest.approx(evaluator.evaluate(rows))


@pytest.mark.parametrize("score", ["score", "fine_score"])
def test_auc(rows, score):
    got = curves.curve_summary(rows, "y", score).first()
    evaluator = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol="y", numBins=0)
    assert got["roc_auc"] == pytest.approx(evaluator.evaluate(rows))


def test_known_curve(spark):
    rows = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, s double")
    got = curves.curve_summary(rows, "y", "s").first()
    assert got["roc_auc"] == pytest.approx(0.75)
    assert got["average_precision"] == pytest.approx(5 / 6)


def test_areas_need_two_classes(spark):
    rows = spark.createDataFrame([(1, 1, 0.2), (1, 1, 0.7)], "y int, p int, s double")
    got = evaluate.classification_metrics(rows, "y", "p", "s").first()
    assert got["roc_auc"] is None
    assert got["accuracy"] == 1.0


def test_empty_divisions_are_zero(spark):
    rows = spark.createDataFrame([(0, 1), (0, 1)], "y int, p int")
    got = evaluate.classification_metrics(rows, "y", "p").first()
    assert tuple(got) == (0.0, 0.0, 0.0, 0.0)


def test_label_and_prediction_of_different_types(spark):
    rows = spark.createDataFrame([(0, 0.0), (1, 1.0), (1, 0.0)], "y int, p double")
    assert evaluate.classification_metrics(rows, "y", "p").first()["accuracy"] == pytest.approx(2 / 3)
    assert evaluate.confusion_matrix(rows, "y", "p", dense=True).count() == 4


def test_first_best_threshold_wins(spark):
    rows = spark.createDataFrame([(1, 0.9), (0, 0.1)], "y int, s double")
    got = curves.best_threshold(rows, "y", "s", "accuracy", [0.8, 0.5, 0.2, 0.95]).first()
    assert tuple(got) == (0.8, 1.0)
    with pytest.raises(ValueError, match="Unknown metric"):
        curves.best_threshold(rows, "y", "s", "auc")


def test_unknown_names_raise(rows):
    with pytest.raises(ValueError, match="average"):
        evaluate.classification_metrics(rows, "y", "prediction", average="median")
    with pytest.raises(ValueError, match="task"):
        validation.fold_scores(rows, "y", task="clustering")


def test_verdict_is_strict(rows):
    same = evaluate.champion_verdict(rows, "y", "prediction", "prediction").first()
    assert same["improved"] is False
    assert evaluate.champion_verdict(rows, "y", "prediction").first()["improved"] is True


def test_metric_that_cannot_be_computed_is_skipped(t):
    rows = scored(t).withColumn("fold", F.col("month") % 2)
    with pytest.warns(UserWarning, match="precision"):
        got = validation.fold_scores(rows, "status", "guess", metrics=["accuracy", "precision", "roc_auc", "f1_macro"])
    assert {r["metric"] for r in got.collect()} == {"accuracy", "f1_macro"}


def test_missing_values_are_errors(spark):
    rows = spark.createDataFrame([(1, 0.9, 1), (None, 0.2, 0), (0, 0.1, 0)], "y int, s double, p int")
    late = spark.createDataFrame([(1, None, 1), (0, 0.1, 0)], "y int, s double, p int")
    for run in (
        lambda: evaluate.classification_metrics(rows, "y", "p"),
        lambda: curves.roc_points(rows, "y", "s"),
        lambda: curves.threshold_sweep(rows, "y", "s"),
        lambda: curves.precision_recall_points(late, "y", "s"),
        lambda: curves.threshold_sweep(late, "y", "s"),
    ):
        with pytest.raises(PySparkException, match="missing value"):
            run().collect()


def test_confusion_of_many_classes(spark):
    """Only pairs that occur, for any number of classes; a dense matrix of so many is an error."""
    rows = spark.range(6_000).select((F.col("id") % 3_000).alias("y"), (F.col("id") % 1_500).alias("p"))
    got = evaluate.confusion_matrix(rows, "y", "p")
    assert got.count() == 3_000 and got.agg(F.sum("n"), F.min("share")).first() == (6_000, 1.0)
    with pytest.raises(ValueError, match="more than 1000 classes"):
        evaluate.confusion_matrix(rows, "y", "p", dense=True)
