"""Class balancing of a training table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.hashing import hash_number
from larkspur.operators.ranking import rank_index

_CHUNK = 65_536


def draws(wanted: DataFrame) -> DataFrame:
    """A row with ``_draw`` 0..k-1 for each row of ``wanted`` (``_class``, ``_k``, ...), made on the executors in even
    chunks."""
    spark = wanted.sparkSession
    chunk = F.explode(F.expr(f"sequence(0L, (_k - 1) div {_CHUNK}L)"))
    inside = F.explode(F.expr(f"sequence(_chunk * {_CHUNK}L, least(_k, (_chunk + 1) * {_CHUNK}L) - 1)"))
    return (
        wanted.where("_k > 0")
        .withColumn("_chunk", chunk)
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_class", "_chunk")
        .withColumn("_draw", inside)
        .drop("_chunk", "_k")
    )


def over_sample(df: DataFrame, target: str, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Raise every class to the size of the largest by drawing rows again, with replacement.

    Column ``copy`` is 0 for the original row and 1, 2, ... for drawn copies.
    """
    index = rank_index(df, keys, seed, by=target)
    top = index.classes.agg(F.coalesce(F.max("_total"), F.lit(0))).first()[0]
    drawn = (
        draws(index.classes.withColumn("_k", F.lit(top) - F.col("_total")))
        .withColumn("_rank", hash_number(F.col("_class"), F.col("_draw"), seed) % F.col("_total"))
        .groupBy("_class", "_rank")
        .agg(F.count("*").alias("_copies"))
    )
    copies = index.at_ranks(drawn).withColumn("copy", F.explode(F.expr("sequence(1, int(_copies))")))
    return df.withColumn("copy", F.lit(0)).unionByName(copies.select(*df.columns, "copy"))


def under_sample(df: DataFrame, target: str, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Cut every class to the size of the smallest, without replacement."""
    index = rank_index(df, keys, seed, by=target)
    bottom = index.classes.agg(F.coalesce(F.min("_total"), F.lit(0))).first()[0]
    return index.cut(F.array(F.lit(bottom))).where(F.col("part") == 0).drop("part")
