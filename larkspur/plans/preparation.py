"""Data preparation from end to end: CSV, preprocessing, split, audited train and test tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from larkspur.operators.prep import FeatureSpec, prepare
from larkspur.operators.splits import random_split, stratified_split
from larkspur.operators.tables import save_table
from larkspur.sources.files import read_csv
from larkspur.workspace import materialize


def prepare_and_split(
    raw: DataFrame, spec: FeatureSpec, test_size: float = 0.2, seed: int = 42, stratify: bool = False, custom=None
) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the prepared rows; with ``stratify`` the class shares of the target are kept.

    The prepared rows are written once: the split counts them before it filters them, and the source is read a single time.
    """
    rows = materialize(prepare(raw, spec, custom), "prepared")
    if stratify:
        return stratified_split(rows, spec.target_name, spec.keys, test_size, seed)
    return random_split(rows, spec.keys, test_size, seed)


def prepare_tables(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    spec: FeatureSpec,
    train_table: str,
    test_table: str,
    mode: str = "append",
    at: datetime | str | None = None,
    **options,
) -> None:
    """Read a CSV, prepare and split it, and write both parts with their load time."""
    train, test = prepare_and_split(read_csv(spark, path, schema), spec, **options)
    save_table(train, train_table, mode, at=at)
    save_table(test, test_table, mode, at=at)
