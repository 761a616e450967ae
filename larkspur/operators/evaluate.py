"""Classification metrics as tables.

Everything starts from the counts per (true, predicted) class, so the data is scanned once and reduced before the
shuffle. ``by`` keeps one result per group: per fold, per model or per time window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, NumericType

from larkspur.functions.columns import present, ratio
from larkspur.operators.curves import curve_summary
from larkspur.workspace import materialize

METRICS = ("accuracy", "precision", "recall", "f1")
#: Classes of a dense confusion matrix, at most.
DENSE_CLASSES = 1_000


def _common_type(df: DataFrame, *columns: str) -> str:
    """Type in which the columns can be compared: their own, or double, or text."""
    kinds = [df.schema[c].dataType for c in columns]
    if len({k.simpleString() for k in kinds}) == 1:
        return kinds[0].simpleString()
    return "double" if all(isinstance(k, NumericType) for k in kinds) else "string"


def pair_counts(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Rows per (true, predicted) class; both classes in one type. A missing label or prediction fails the query.

    ``weight`` is a column of row counts, where rows have been counted before.
    """
    kind = _common_type(df, label, prediction)
    return df.groupBy(
        *by, present(df, label).cast(kind).alias("label"), present(df, prediction).cast(kind).alias("prediction")
    ).agg((F.sum(weight) if weight else F.count("*")).alias("n"))


def class_metrics(
    df: DataFrame, label: str, prediction: str, by: Sequence[str] = (), weight: str | None = None
) -> DataFrame:
    """Per class: support, true and false positives, false negatives, precision, recall and F1."""
    pairs = pair_counts(df, label, prediction, by, weight)
    same = F.col("label").eqNullSafe(F.col("prediction"))
    # Each pair tells its true class about a hit or a miss, and its predicted class about a false alarm.
    own = F.struct(
        F.col("label").alias("class"),
        F.when(same, F.col("n")).otherwise(0).alias("tp"),
        F.lit(0).cast("long").alias("fp"),
        F.when(same, 0).otherwise(F.col("n")).alias("fn"),
    )
    other = F.struct(
        F.col("prediction").alias("class"),
        F.lit(0).cast("long").alias("tp"),
        F.when(same, 0).otherwise(F.col("n")).alias("fp"),
        F.lit(0).cast("long").alias("fn"),
    )
    return (
        pairs.select(*by, F.explode(F.array(own, other)).alias("c"))
        .select(*by, "c.*")
        .groupBy(*by, "class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
        .withColumns(
            {
                "support": F.col("tp") + F.col("fn"),
                "precision": ratio(F.col("tp"), F.col("tp") + F.col("fp")),
                "recall": ratio(F.col("tp"), F.col("tp") + F.col("fn")),
                "f1": ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")),
            }
        )
    )


def classification_metrics(
    df: DataFrame,
    label: str,
    prediction: str,
    score: str | None = None,
    average: str = "weighted",
    by: Sequence[str] = (),
    positive: int = 1,
    weight: str | None = None,
) -> DataFrame:
    """Accuracy, precision, recall and F1, 0 on an empty division; one row, or one per group.

    ``average`` is weighted, macro, micro or binary. With a score also ``roc_auc`` and ``average_precision``, null
    unless there are exactly two true classes.
    """
    if average not in ("weighted", "macro", "micro", "binary"):
        raise ValueError(f"Unknown average: {average}")
    classes = class_metrics(df, label, prediction, by, weight)

    def averaged(name: str) -> Column:
        if average == "weighted":
            return ratio(F.sum(F.col("support") * F.col(name)), F.sum("support"))
        if average == "macro":
            return F.avg(name)
        if average == "micro":
            # Every false alarm of one class is a miss of another, so all three coincide.
            return ratio(F.sum("tp"), F.sum("support"))
        return F.coalesce(F.max(F.when(F.col("class") == positive, F.col(name))), F.lit(0.0))

    result = classes.groupBy(*by).agg(
        ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[averaged(m).alias(m) for m in METRICS[1:]],
        F.count_if(F.col("support") > 0).alias("_true_classes"),
    )
    if score is None:
        return result.drop("_true_classes")
    areas = curve_summary(df, label, score, by, positive)
    names = ("roc_auc", "average_precision")
    if by:
        result, values = result.join(areas, list(by)), {c: F.col(c) for c in names}
    else:
        both = areas.select(F.struct(*names)).scalar()
        values = {c: both[c] for c in names}
    binary = F.col("_true_classes") == 2
    return result.withColumns({c: F.when(binary, v) for c, v in values.items()}).drop("_true_classes")


def confusion_matrix(df: DataFrame, label: str, prediction: str, dense: bool = False) -> DataFrame:
    """(true, predicted) pairs with their count and their share of the true class.

    Pairs that occur, for any number of classes; with ``dense`` every pair of the classes seen, up to ``DENSE_CLASSES`` of them.
    """
    filled = pair_counts(df, label, prediction)
    if dense:
        pairs = materialize(filled, "pairs")
        seen = pairs.select(F.explode(F.array("label", "prediction")).alias("label")).distinct()
        classes = [r[0] for r in seen.limit(DENSE_CLASSES + 1).collect()]
        if len(classes) > DENSE_CLASSES:
            raise ValueError(f"a dense matrix of more than {DENSE_CLASSES} classes")
        kind = pairs.schema["label"].dataType
        every = F.array(*[F.lit(c).cast(kind) for c in classes]).cast(ArrayType(kind))
        grid = seen.select("label", F.explode(every).alias("prediction"))
        filled = grid.join(pairs, ["label", "prediction"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    row = F.sum("n").over(Window.partitionBy("label"))
    return filled.withColumn("share", F.when(row > 0, F.col("n") / row))


def champion_verdict(
    df: DataFrame, label: str, challenger: str, champion: str | None = None, metric: str = "f1", score: bool = False
) -> DataFrame:
    """One row: both models' metric on the same rows, and whether the challenger is strictly better.

    The metric is weighted F1 on predictions, or ``roc_auc`` on score columns. Without a champion it is improved.
    """
    if score:
        metric = "roc_auc"
    names = {"challenger": challenger, **({"champion": champion} if champion else {})}
    kind = _common_type(df, *names.values())
    values = [F.struct(F.lit(k).alias("model"), F.col(v).cast(kind).alias("value")) for k, v in names.items()]
    tall = df.select(F.col(label).alias("label"), F.explode(F.array(*values)).alias("m")).select("label", "m.*")
    if score:
        table = curve_summary(tall, "label", "value", ["model"])
    else:
        table = classification_metrics(tall, "label", "value", by=["model"])
    row = table.agg(*[F.max(F.when(F.col("model") == m, F.col(metric))).alias(m) for m in ("challenger", "champion")])
    improved = F.lit(True) if champion is None else F.col("challenger") > F.col("champion")
    return row.withColumn("improved", improved)
