"""The registered queries, each with its SQL twin where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from larkspur.session import configure


@dataclass(frozen=True)
class Tables:
    """The given Parquet tables of one scale, read on first use."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name."""

    def add(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(Tables(configure(spark), folder))

        run.__doc__ = build.__doc__
        QUERIES[name] = run
        if sql is not None:
            TWINS[name] = sql
        return build

    return add
