"""Labelled inference rows, quality profiles per time window, and threshold checks."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.functions.columns import ratio
from larkspur.operators.feature_table import latest_per_key
from larkspur.operators.joins import attach_label
from larkspur.operators.prep import drop_incomplete
from larkspur.operators.profiles import observation_counts, profile_of
from larkspur.operators.tables import insert_by_name, save_table, table_exists
from larkspur.workspace import materialize

# Profile window and the smallest accepted mean of weighted F1 x 100.
WINDOW = "30 minutes"
FLOOR = 75.0

# Rank error of at most one in a thousand; keeps a stream window's sketch to a few kilobytes.
_MEDIAN_ACCURACY = 1_000

_COMPARE = {
    "LESS_THAN": operator.lt,
    "LESS_THAN_OR_EQUAL": operator.le,
    "GREATER_THAN": operator.gt,
    "GREATER_THAN_OR_EQUAL": operator.ge,
    "EQUAL": operator.eq,
    "NOT_EQUAL": operator.ne,
}


def label_predictions(flat: DataFrame, sources: Sequence[DataFrame], key: str, label: str) -> DataFrame:
    """Attach the true label as ``status``, make both sides double, and drop rows that lack either."""
    labelled = attach_label(flat, sources, key, label).withColumns(
        {"status": F.col("status").cast("double"), "prediction": F.col("prediction").cast("double")}
    )
    return drop_incomplete(labelled, ["status", "prediction"])


def new_rows(rows: DataFrame, existing: DataFrame, keys: Sequence[str], time: str = "timestamp") -> DataFrame:
    """Rows whose key the table does not hold yet, one per key: the last by time, other columns settling ties."""
    return latest_per_key(rows, keys, [time]).join(existing.select(*keys), list(keys), "left_anti")


def append_new(spark: SparkSession, rows: DataFrame, table: str, keys: Sequence[str], time: str = "timestamp") -> None:
    """Append the rows a monitoring table lacks. The table is split by day."""
    dated = rows.withColumn("event_date", F.to_date(time))
    if not table_exists(spark, table):
        save_table(latest_per_key(dated, keys, [time]), table, "error", partition_by=["event_date"], audit=False)
        return
    # Parsed and joined once; only the days the new rows span are read from the table.
    arrived = materialize(dated, "arrived")
    first, last = arrived.agg(F.min("event_date"), F.max("event_date")).first()
    # Rows without a time have no day; those the table holds are compared too.
    held = spark.table(table).where(F.col("event_date").between(first, last) | F.col("event_date").isNull())
    insert_by_name(new_rows(arrived, held, keys, time).hint("rebalance", "event_date"), table)


def profile_columns(label: str, prediction: str, numeric: Sequence[str]) -> list[Column]:
    """The statistics of one window that are aggregates in one pass, as a stream takes them."""
    y, p = F.col(label), F.col(prediction)
    error = p - y
    n = F.count("*")
    columns = [n.alias("rows")]
    for c in numeric:
        columns += [
            F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"),
            F.avg(c).alias(f"{c}_mean"),
            F.stddev(c).alias(f"{c}_stddev"),
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
        ]
    variation = n * F.var_pop(y)
    columns += [
        F.avg(error * error).alias("mse"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.when(variation > 0, 1 - F.sum(error * error) / variation).alias("r2"),
        ratio(F.count_if(y == p), n).alias("accuracy_score"),
    ]
    return columns


def stream_columns(label: str, prediction: str, numeric: Sequence[str], classes: Sequence[float]) -> list[Column]:
    """What a stream adds in the same pass: sketched medians, named so, and weighted F1 over the stated classes.

    A label or prediction that is none of the classes fails the stream.
    """
    y, p = F.col(label), F.col(prediction)
    weighted = [
        F.count_if(y == c)
        * ratio(2.0 * F.count_if((y == c) & (p == c)), F.count_if(y == c) + F.count_if(p == c))
        for c in classes
    ]
    score = ratio(reduce(operator.add, weighted), F.count("*"))
    other = F.count_if(~y.isin(*classes) | ~p.isin(*classes)) > 0
    unknown = F.raise_error(F.lit(f"a class other than {list(classes)}")).cast("double")
    return [
        *[F.approx_percentile(c, 0.5, _MEDIAN_ACCURACY).alias(f"{c}_median_approx") for c in numeric],
        F.when(other, unknown).otherwise(score).alias("f1_score_weighted"),
    ]


def profile(
    df: DataFrame,
    time: str = "timestamp",
    model: str = "model_name",
    label: str = "status",
    prediction: str = "prediction",
    numeric: Sequence[str] = (),
    classes: Sequence[float] | None = None,
    every: str = WINDOW,
) -> DataFrame:
    """One row per time window and model: statistics of the numeric columns and the quality of the predictions.

    Medians are exact (the lower one of two) and classes are those that occur; both come from counts that are taken in one
    pass over the rows (``profiles``). With ``classes``, as a stream needs, it is one aggregation over the stated classes,
    and medians are sketches named ``_median_approx``.
    """
    if classes is None:
        kinds = {c: df.schema[c].dataType.simpleString() for c in numeric}
        counts = observation_counts(df, time, model, label, prediction, kinds, every)
        return profile_of(materialize(counts, "counts"), kinds)
    windows = [F.window(time, every).alias("_window"), F.col(model).alias("model_name")]
    columns = profile_columns(label, prediction, numeric)
    result = df.groupBy(*windows).agg(*columns, *stream_columns(label, prediction, numeric, classes))
    return (
        result.select("_window.start", "_window.end", "*")
        .drop("_window")
        .withColumnsRenamed({"start": "window_start", "end": "window_end"})
    )


def check(profile_table: DataFrame, metric: str = "f1_score_weighted", op: str = "LESS_THAN", threshold: float = FLOOR) -> DataFrame:
    """One row: the mean of a metric x 100, the threshold, and whether the condition holds."""
    if op not in _COMPARE:
        raise ValueError(f"Unknown operator: {op}")
    name = f"avg_{metric}"
    return (
        profile_table.agg((F.avg(metric) * 100.0).alias(name))
        .withColumn("threshold", F.lit(float(threshold)))
        .withColumn("triggered", _COMPARE[op](F.col(name), F.col("threshold")))
    )
