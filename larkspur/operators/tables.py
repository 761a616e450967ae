"""Writing and managing tables.

Tables are Parquet tables of the session catalog. Errors are raised, never turned into a return value.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the audit column.
AUDIT_COLUMN = "update_timestamp_utc"

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_SETTING = threading.Lock()


def with_audit(
    df: DataFrame,
    metadata: Mapping[str, Any] | None = None,
    at: datetime | str | None = None,
    zone: str = "UTC",
    column: str = AUDIT_COLUMN,
) -> DataFrame:
    """Add the load time in UTC and one literal column per metadata entry. Pass ``at`` for a repeatable run."""
    moment = F.current_timestamp() if at is None else F.lit(at).cast("timestamp")
    added = {column: F.to_utc_timestamp(moment, zone)}
    added.update({k: F.lit(v) for k, v in (metadata or {}).items()})
    return df.withColumns(added)


def save_table(
    df: DataFrame,
    name: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    audit: bool = True,
    metadata: Mapping[str, Any] | None = None,
    at: datetime | str | None = None,
) -> None:
    """Write with mode overwrite, append, ignore or error. Append matches columns by name."""
    spark = df.sparkSession
    rows = with_audit(df, metadata, at) if audit else df
    if mode == "append" and table_exists(spark, name):
        insert_by_name(rows, name)
        return
    # Rows of one partition value go to few files, and a large value is still split over tasks.
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    writer = rows.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)


def insert_by_name(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """``INSERT INTO`` aligned by column name; a column the rows lack or have in excess is an error.

    With ``overwrite``, the partitions that occur in the rows are replaced and all others stay.
    """
    target = df.sparkSession.table(name).columns
    if set(target) != set(df.columns):
        raise ValueError(f"columns differ: table {sorted(target)}, rows {sorted(df.columns)}")
    spark, rows = df.sparkSession, df.select(*target)
    if not overwrite:
        rows.write.insertInto(name)
        return
    # Only the session setting counts for an insert; a writer option is not looked at. One thread at a time changes it.
    with _SETTING:
        previous = spark.conf.get(_OVERWRITE_MODE)
        spark.conf.set(_OVERWRITE_MODE, "dynamic")
        try:
            rows.write.insertInto(name, overwrite=True)
        finally:
            spark.conf.set(_OVERWRITE_MODE, previous)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def create_or_update(df: DataFrame, name: str, update_mode: str = "append", **options) -> None:
    """Create the table if it is absent, otherwise append to it or overwrite it."""
    if update_mode not in ("append", "overwrite"):
        raise ValueError(f"Unknown update mode: {update_mode}")
    save_table(df, name, mode=update_mode if table_exists(df.sparkSession, name) else "overwrite", **options)


def drop_table(spark: SparkSession, name: str, if_exists: bool = True) -> bool:
    """True when a table was dropped. An absent table gives False, or an error without ``if_exists``."""
    if if_exists and not table_exists(spark, name):
        return False
    spark.sql(f"DROP TABLE {name}")
    return True


def truncate_table(spark: SparkSession, name: str) -> None:
    """Remove the rows and keep the schema."""
    spark.sql(f"TRUNCATE TABLE {name}")


def newest_rows(df: DataFrame, column: str = AUDIT_COLUMN) -> DataFrame:
    """Rows of the latest load: audit time at or after the table's own maximum (a scalar subquery)."""
    return df.where(F.col(column) >= df.agg(F.max(column)).scalar())
