"""Tables and SQL."""

from __future__ import annotations

import re
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def read_sql(spark: SparkSession, query: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Run a query with values bound to ``:name`` or ``${name}`` markers.

    Values are bound, never pasted into the text; ``IDENTIFIER(:t)`` takes a table name.
    """
    if not params:
        return spark.sql(query)
    return spark.sql(re.sub(r"\$\{(\w+)\}", r":\1", query), args=dict(params))


def read_sql_file(spark: SparkSession, path: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """As ``read_sql``, with the text in a file any Hadoop file system can hold."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return read_sql(spark, text, params)
