"""Counts, shares, unions and top lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_count(df: DataFrame) -> DataFrame:
    """Rows and columns as a one-row table."""
    return df.agg(F.count("*").alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def value_counts(df: DataFrame, column: str, drop_nulls: bool = True) -> DataFrame:
    """Rows per value; nulls are left out unless asked for."""
    rows = df.where(F.col(column).isNotNull()) if drop_nulls else df
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Share of each value. The total is taken over the counted table: one scan of the data."""
    counted = value_counts(df, column)
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("share", F.col("n") / total)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def score_summary(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Mean and population standard deviation of fold scores."""
    return df.groupBy(*by).agg(F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"))


def top_n(df: DataFrame, value: str, name: str, n: int | None = None) -> DataFrame:
    """Largest values first; the name settles ties."""
    ordered = df.orderBy(F.desc(value), F.asc(name))
    return ordered if n is None else ordered.limit(n)


def union_by_name(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union that fills columns either side lacks with null."""
    return first.unionByName(second, allowMissingColumns=True)


def with_share_of(df: DataFrame, value: str, by: list[str], name: str) -> DataFrame:
    """Value as a share of its group's sum, for small pre-aggregated tables."""
    return df.withColumn(name, F.col(value) / F.sum(value).over(Window.partitionBy(*by)))
