"""Monitoring from end to end: log, flat rows, labels, monitoring table, profile, alert."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from larkspur.operators import monitor
from larkspur.operators.payload import REQUEST_ID, flatten


def refresh(
    spark: SparkSession,
    log: DataFrame,
    label_sources: Sequence[DataFrame],
    table: str,
    record: StructType,
    fields: Mapping[str, str],
    model: str,
    key: str,
    label: str,
) -> DataFrame:
    """Bring the monitoring table up to date with the log and return it."""
    rows = monitor.label_predictions(flatten(log, record, fields, model), label_sources, key, label)
    monitor.append_new(spark, rows, table, [REQUEST_ID, "position"])
    return spark.table(table)


def quality_report(table: DataFrame, numeric: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(profile per window, alert row)."""
    profile = monitor.profile(table, numeric=numeric)
    return profile, monitor.check(profile)
