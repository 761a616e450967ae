"""Exact, seeded train/test splits and folds."""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.operators.ordering import with_position
from larkspur.operators.ranking import rank_index


def _test_rows(n: int, test_size: float) -> int:
    """ceil(n * share), with the share read as the decimal it was written as."""
    return math.ceil(n * Fraction(str(test_size)))


def _two(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    train = marked.where(F.col("part") > 0).drop("part")
    test = marked.where(F.col("part") == 0).drop("part")
    return train, test


def _share(rows: Column, share: float) -> Column:
    """ceil(rows * share) in whole numbers, with the share read as the decimal it was written as."""
    exact = Fraction(str(share))
    whole = rows.cast("decimal(20,0)") * exact.numerator
    return F.ceil(whole / F.lit(exact.denominator).cast("decimal(18,0)")).cast("long")


def random_split(
    df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ceil(n * test_size) test rows. Both are plain filters on the input."""
    index = rank_index(df, keys, seed)
    return _two(index.cut(F.array(_share(F.col("_total"), test_size))))


def class_quotas(classes: DataFrame, wanted: int) -> DataFrame:
    """Share ``wanted`` rows among the classes (``_class``, ``_total``) in proportion, as ``_quota``: by largest
    remainder, larger class first on ties."""
    n = classes.agg(F.coalesce(F.sum("_total"), F.lit(0))).first()[0]
    exact = F.col("_total").cast("decimal(20,0)") * F.lit(wanted).cast("decimal(18,0)")
    shared = classes.withColumns({"_over": exact % F.lit(max(n, 1)).cast("decimal(18,0)")})
    shared = shared.withColumn("_base", ((exact - F.col("_over")) / F.lit(max(n, 1)).cast("decimal(18,0)")).cast("long"))
    left = wanted - (shared.agg(F.coalesce(F.sum("_base"), F.lit(0))).first()[0])
    placed = with_position(shared, [F.desc("_over"), F.desc("_total"), "_class"], "_turn")
    quota = F.col("_base") + F.when(F.col("_turn") < left, 1).otherwise(0)
    return placed.select("_class", "_total", quota.alias("_quota"))


def stratified_split(
    df: DataFrame, target: str, keys: Sequence[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) of exact sizes with the class shares kept in both; any number of classes."""
    index = rank_index(df, keys, seed, by=target)
    smallest, n, classes = index.classes.agg(
        F.coalesce(F.min("_total"), F.lit(0)), F.coalesce(F.sum("_total"), F.lit(0)), F.count("*")
    ).first()
    if smallest < 2:
        raise ValueError(f"a class of {target} has fewer than 2 rows")
    wanted = _test_rows(n, test_size)
    if min(wanted, n - wanted) < classes:
        raise ValueError(f"{classes} classes do not fit into {wanted} test and {n - wanted} train rows")
    return _two(index.cut(F.array("_quota"), classes=class_quotas(index.classes, wanted)))


def with_fold(
    df: DataFrame, target: str | None, keys: Sequence[str], folds: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Add a fold number 0..folds-1; each class is dealt out evenly."""
    index = rank_index(df, keys, seed, by=target)
    return index.cut(F.array(*[F.expr(f"_total * {i} div {folds}") for i in range(1, folds)]).cast("array<long>"), name)


def nested_shares(
    df: DataFrame, target: str | None, keys: Sequence[str], shares: Sequence[float], seed: int = 42
) -> DataFrame:
    """Add ``part``: the row belongs to the i-th share, and to all larger ones, when ``part <= i``."""
    index = rank_index(df, keys, seed, by=target)
    return index.cut(F.array(*[_share(F.col("_total"), s) for s in shares]))
