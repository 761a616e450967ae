"""Cross-validation, model comparison and learning curves.

Each fold is a distributed fit; a few fits run at a time, as each leaves much of a cluster idle. What the preprocessing of
all folds and training shares has to know comes from one pass, whose parts add up. The predictions of all folds become one
table, and every metric of every fold comes out of one grouped aggregation over it.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.operators.curves import curve_summary
from larkspur.operators.evaluate import classification_metrics
from larkspur.operators.splits import nested_shares, with_fold
from larkspur.workspace import materialize

CLASSIFICATION = ("accuracy", "precision", "recall", "f1", "roc_auc")
REGRESSION = ("r2", "neg_mean_squared_error", "neg_mean_absolute_error")
_AVERAGED = ("precision", "recall", "f1")
#: Fits at a time.
PARALLEL = 4


def _at_once(work, jobs: Sequence) -> list:
    """The results of ``work`` for each job, a few at a time."""
    pool = ThreadPool(min(PARALLEL, max(1, len(jobs))))
    try:
        return pool.map(inheritable_thread_target(work), jobs, chunksize=1)
    finally:
        pool.close()


def _tall(wide: DataFrame, by: Sequence[str], names: dict[str, str]) -> DataFrame:
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(c).cast("double").alias("value")) for m, c in names.items()]
    return wide.select(*by, F.explode(F.array(*pairs)).alias("m")).select(*by, "m.*")


def regression_metrics(df: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """R2, the two negated errors and RMSE, one row per group."""
    y = F.col(label).cast("double")
    error = F.col(prediction).cast("double") - y
    spread = F.count("*") * F.var_pop(y)
    return df.groupBy(*by).agg(
        F.when(spread > 0, 1 - F.sum(error * error) / spread).alias("r2"),
        (-F.avg(error * error)).alias("neg_mean_squared_error"),
        (-F.avg(F.abs(error))).alias("neg_mean_absolute_error"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def fold_scores(
    predictions: DataFrame,
    label: str,
    prediction: str = "prediction",
    probability: str = "probability",
    by: Sequence[str] = ("fold",),
    task: str = "classification",
    metrics: Sequence[str] | None = None,
    weight: str | None = None,
) -> DataFrame:
    """``by..., metric, value``: every metric of every fold.

    ``precision``, ``recall`` and ``f1`` look at class 1 and need two classes; a suffix ``_weighted``, ``_macro`` or
    ``_micro`` averages over the classes. A metric that cannot be computed is left out with a warning. ``weight`` is a
    column of row counts, where rows have been counted per label and prediction; areas and errors need the rows.
    """
    if task not in ("classification", "regression"):
        raise ValueError(f"Unknown task type: {task}")
    wanted = list(metrics or (CLASSIFICATION if task == "classification" else REGRESSION))
    if task == "regression":
        return _regression_scores(predictions, label, prediction, by, wanted)
    binary = predictions.select(label).distinct().limit(3).count() == 2
    averages: dict[str, dict[str, str]] = {}
    parts: list[DataFrame] = []
    for metric in wanted:
        base, _, average = metric.partition("_")
        if metric == "accuracy":
            averages.setdefault("weighted", {})[metric] = metric
        elif metric == "roc_auc":
            if binary:
                areas = curve_summary(predictions, label, probability, by)
                parts.append(_tall(areas, by, {metric: metric}))
        elif base in _AVERAGED and average in ("", "weighted", "macro", "micro") and (average or binary):
            averages.setdefault(average or "binary", {})[metric] = base
        else:
            warnings.warn(f"Could not calculate {metric}", stacklevel=2)
    for average, names in averages.items():
        found = classification_metrics(predictions, label, prediction, average=average, by=by, weight=weight)
        parts.append(_tall(found, by, names))
    if not parts:
        raise ValueError(f"none of the metrics {wanted} can be computed")
    return reduce(DataFrame.unionByName, parts)


def _regression_scores(predictions, label, prediction, by, wanted) -> DataFrame:
    names = {}
    for metric in wanted:
        if metric not in REGRESSION:
            warnings.warn(f"Could not calculate {metric}", stacklevel=3)
            continue
        names[metric] = metric
        if metric == "neg_mean_squared_error":
            names["rmse"] = "rmse"
    return _tall(regression_metrics(predictions, label, prediction, by), by, names)


def summarize(scores: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per metric: mean, population standard deviation, and the fold values in fold order."""
    values = F.transform(F.array_sort(F.collect_list(F.struct("fold", "value"))), lambda x: x["value"])
    return scores.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"), values.alias("values")
    )


def fold_predictions(
    plans: Sequence[tuple[str, object]], df: DataFrame, label: str, keys: Sequence[str], cv: int = 5, seed: int = 42
) -> DataFrame:
    """Out-of-fold ``model, fold, label, prediction, probability`` of every row, written once.

    The models share the folds; those with the same preprocessing share its statistics.
    """
    folded = materialize(with_fold(df, label, keys, cv, seed, "_fold"), "folds")
    others = [set(range(cv)) - {fold} for fold in range(cv)]
    fitted: list[tuple] = []
    for _, plan in plans:
        if all(plan.preprocessor != known for known, _ in fitted):
            fitted.append((plan.preprocessor, plan.preprocessor.fit_unions(folded, "_fold", others, [*keys, label])))

    def predicted(job: tuple[str, object, int]) -> DataFrame:
        name, plan, fold = job
        prepared = next(found for known, found in fitted if known == plan.preprocessor)
        train = folded.where(F.col("_fold") != fold).drop("_fold")
        model = plan.fit(train, label, keys, prepared[fold])
        tested = model.score(folded.where(F.col("_fold") == fold).drop("_fold"), keys)
        return tested.select(
            F.lit(name).alias("model"), F.lit(fold).alias("fold"), F.col(label).cast("double").alias(label), "prediction", "probability"
        )

    jobs = [(name, plan, fold) for name, plan in plans for fold in range(cv)]
    return materialize(reduce(DataFrame.unionByName, _at_once(predicted, jobs)), "predictions")


def cross_validate(
    plan,
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    cv: int = 5,
    metrics: Sequence[str] | None = None,
    task: str = "classification",
    seed: int = 42,
) -> DataFrame:
    """``metric, mean, std, values`` over the folds."""
    predictions = fold_predictions([("", plan)], df, label, keys, cv, seed)
    return summarize(fold_scores(predictions, label, task=task, metrics=metrics))


def compare_scores(scores: DataFrame) -> DataFrame:
    """One row per model with ``<metric>_mean`` and ``<metric>_std`` columns, from ``model, fold, metric, value``."""
    # At most the handful of metrics asked for.
    metrics = sorted(r[0] for r in scores.select("metric").distinct().collect())
    value = {m: F.when(F.col("metric") == m, F.col("value")) for m in metrics}
    columns = [c for m in metrics for c in (F.avg(value[m]).alias(f"{m}_mean"), F.stddev_pop(value[m]).alias(f"{m}_std"))]
    return scores.groupBy("model").agg(*columns)


def compare_models(
    plans: Sequence[tuple[str, object]],
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    cv: int = 5,
    metrics: Sequence[str] | None = None,
    task: str = "classification",
    seed: int = 42,
) -> DataFrame:
    """Cross-validate several models on the same folds, one row per model."""
    predictions = fold_predictions(plans, df, label, keys, cv, seed)
    scores = fold_scores(predictions, label, by=["model", "fold"], task=task, metrics=metrics)
    return compare_scores(materialize(scores, "scores"))


def learning_curve(
    plan,
    df: DataFrame,
    label: str,
    keys: Sequence[str],
    cv: int = 5,
    train_sizes: Sequence[float] = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0),
    metric: str = "accuracy",
    seed: int = 42,
) -> DataFrame:
    """Per training share: rows used, and mean and standard deviation of train and test score over the folds.

    The shares are nested: a larger one holds the rows of every smaller one.
    """
    sizes, areas = sorted(train_sizes), metric == "roc_auc"
    folded = materialize(with_fold(df, label, keys, cv, seed, "_fold"), "folds")

    def shared(fold: int) -> DataFrame:
        rest = folded.where(F.col("_fold") != fold).drop("_fold")
        return materialize(nested_shares(rest, label, keys, sizes, seed), "shares")

    trains = _at_once(shared, range(cv))
    unions = [set(range(i + 1)) for i in range(len(sizes))]
    prepared = _at_once(lambda fold: plan.preprocessor.fit_unions(trains[fold], "part", unions, [*keys, label]), range(cv))

    def scored(job: tuple[int, int]) -> DataFrame:
        fold, i = job
        some = trains[fold].where(F.col("part") <= i).drop("part")
        model = plan.fit(some, label, keys, prepared[fold][i])
        both = some.withColumn("_kind", F.lit("train")).unionByName(
            folded.where(F.col("_fold") == fold).drop("_fold").withColumn("_kind", F.lit("test"))
        )
        rows = model.score(both, keys).select(
            F.lit(float(sizes[i])).alias("share"), F.lit(fold).alias("fold"), F.col("_kind").alias("kind"),
            F.col(label).cast("double").alias(label), "prediction", "probability",
        )
        # Most metrics follow from the rows per label and prediction; only areas look at each score.
        return rows if areas else rows.groupBy("share", "fold", "kind", label, "prediction").agg(F.count("*").alias("_n"))

    jobs = [(fold, i) for fold in range(cv) for i in range(len(sizes))]
    tables = _at_once(lambda job: materialize(scored(job), "predictions"), jobs)
    predictions = reduce(DataFrame.unionByName, tables)
    by = ["share", "fold", "kind"]
    scores = fold_scores(predictions, label, by=by, metrics=[metric], weight=None if areas else "_n")
    counted = F.count("*") if areas else F.sum("_n")
    used = predictions.where("kind = 'train'").groupBy("share", "fold").agg(counted.alias("rows"))
    value = {k: F.when(F.col("kind") == k, F.col("value")) for k in ("train", "test")}
    return (
        scores.join(used, ["share", "fold"])
        .groupBy("share")
        .agg(
            F.max("rows").alias("train_rows"),
            *[F.avg(value[k]).alias(f"{k}_mean") for k in value],
            *[F.stddev_pop(value[k]).alias(f"{k}_std") for k in value],
        )
    )
