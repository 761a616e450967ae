"""ROC and precision-recall points, the areas under them, and threshold sweeps.

Rows are first counted per distinct score, then running totals are taken over the scores from the highest down, without a
one-task sort.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.columns import present, ratio
from larkspur.operators.ordering import running_totals

# Thresholds tried by default.
THRESHOLDS = tuple(float(t) for t in np.linspace(0.01, 0.99, 100))
SWEEP_METRICS = ("f1", "accuracy", "precision", "recall")


def score_totals(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), positive: int = 1
) -> DataFrame:
    """Per distinct score: positives and negatives at it (``pos``, ``neg``), at or above it (``tp``, ``fp``), and in all
    (``p``, ``n``). One group per value of ``by``. A missing score or label fails the query."""
    counted = (
        df.select(*by, present(df, score).cast("double").alias("threshold"), present(df, label).alias("_label"))
        .groupBy(*by, "threshold")
        .agg(
            F.count_if(F.col("_label") == positive).alias("pos"),
            F.count_if(F.col("_label") != positive).alias("neg"),
        )
    )
    running = running_totals(counted, [*by, F.desc("threshold")], {"tp": "pos", "fp": "neg"})
    if not by:
        totals = running.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
        return running.withColumns({"p": totals["p"], "n": totals["n"]})
    # The running total goes through all groups; take off what came before the group.
    groups = running.groupBy(*by).agg(
        F.min(F.col("tp") - F.col("pos")).alias("_tp0"),
        F.min(F.col("fp") - F.col("neg")).alias("_fp0"),
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
    )
    return (
        running.join(groups, list(by))
        .withColumns({"tp": F.col("tp") - F.col("_tp0"), "fp": F.col("fp") - F.col("_fp0")})
        .drop("_tp0", "_fp0")
    )


def curve_summary(df: DataFrame, label: str, score: str, by: Sequence[str] = (), positive: int = 1) -> DataFrame:
    """``roc_auc`` (trapezoids, so a tie counts half) and ``average_precision`` (sum of recall steps times precision)."""
    totals = score_totals(df, label, score, by, positive)
    area = F.sum(F.col("neg") * (2.0 * F.col("tp") - F.col("pos")) / 2.0)
    steps = F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp"))))
    p, n = F.max("p"), F.max("n")
    return totals.groupBy(*by).agg(
        F.when((p > 0) & (n > 0), area / (p * n)).alias("roc_auc"),
        F.when(p > 0, steps / p).alias("average_precision"),
    )


def roc_points(df: DataFrame, label: str, score: str, positive: int = 1) -> DataFrame:
    """One point per distinct score, and the origin with an infinite threshold."""
    points = score_totals(df, label, score, (), positive).select(
        "threshold", (F.col("fp") / F.col("n")).alias("fpr"), (F.col("tp") / F.col("p")).alias("tpr")
    )
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], points.schema)
    return points.unionByName(origin)


def precision_recall_points(df: DataFrame, label: str, score: str, positive: int = 1) -> DataFrame:
    """One point per distinct score, and the end point precision 1, recall 0 without a threshold."""
    points = score_totals(df, label, score, (), positive).select(
        "threshold",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        (F.col("tp") / F.col("p")).alias("recall"),
    )
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def threshold_sweep(
    df: DataFrame, label: str, score: str, thresholds: Sequence[float] | None = None, positive: int = 1
) -> DataFrame:
    """F1, accuracy, precision and recall of ``score >= t`` for every threshold, in one pass.

    Each row is counted once, under the highest threshold it reaches; sums over the handful of thresholds do the rest.
    A missing score or label fails the query.
    """
    tried = list(THRESHOLDS if thresholds is None else thresholds)
    steps = sorted(set(tried))
    cut = Bucketizer(
        splits=[-float("inf"), *steps, float("inf")], inputCol="_score", outputCol="_step", handleInvalid="error"
    )
    reached = cut.transform(
        df.select(present(df, score).cast("double").alias("_score"), (present(df, label) == positive).alias("_hit"))
    )
    counted = reached.groupBy(F.col("_step").cast("int").alias("_step")).agg(
        F.count_if("_hit").alias("pos"), F.count_if(~F.col("_hit")).alias("neg")
    )
    # Steps nobody reached count too; step 0 is below every threshold.
    position = {t: i for i, t in reversed(list(enumerate(tried)))}
    grid = df.sparkSession.createDataFrame(
        [(0, None, None), *[(i + 1, position[t], t) for i, t in enumerate(steps)]],
        "_step int, position int, threshold double",
    )
    full = grid.join(counted, "_step", "left").fillna(0, ["pos", "neg"])
    above = Window.orderBy(F.desc("_step")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    tp, fp = F.col("tp"), F.col("fp")
    return (
        full.withColumns(
            {
                "tp": F.sum("pos").over(above),
                "fp": F.sum("neg").over(above),
                "p": F.sum("pos").over(every),
                "n": F.sum("neg").over(every),
            }
        )
        .where(F.col("threshold").isNotNull())
        .select(
            "position",
            "threshold",
            ratio(2 * tp, tp + fp + F.col("p")).alias("f1"),
            ratio(tp + F.col("n") - fp, F.col("p") + F.col("n")).alias("accuracy"),
            ratio(tp, tp + fp).alias("precision"),
            ratio(tp, F.col("p")).alias("recall"),
        )
    )


def best_threshold(
    df: DataFrame,
    label: str,
    score: str,
    metric: str = "f1",
    thresholds: Sequence[float] | None = None,
    positive: int = 1,
) -> DataFrame:
    """The threshold with the largest metric; the first one tried wins a tie."""
    if metric not in SWEEP_METRICS:
        raise ValueError(f"Unknown metric: {metric}")
    swept = threshold_sweep(df, label, score, thresholds, positive)
    return (
        swept.orderBy(F.desc(metric), "position").limit(1).select("threshold", F.col(metric).alias(f"{metric}_score"))
    )
