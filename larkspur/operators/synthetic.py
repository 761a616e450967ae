"""Synthetic rows with the column distributions of a real table, and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from larkspur.functions.hashing import hash_number
from larkspur.operators.ordering import running_totals
from larkspur.workspace import materialize

# A synthetic key is this prefix and a number, counted up from this one.
KEY_PREFIX = "INS"
KEY_FIRST = 40_000

#: Parts of a sorted column in which draws look for their value.
BLOCKS = 65_536


def value_ranges(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, int]:
    """Each column's distribution as ranges: ``column``, ``value`` as text, and its rows ``ahead`` .. ``through - 1`` when the
    column is sorted, nulls first and numbers as numbers; and the number of rows.

    One pass counts the values of all columns; only the counts are sorted.
    """
    numbers = [c for c in columns if isinstance(df.schema[c].dataType, NumericType)]
    cells = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    counted = df.select(F.explode(F.array(*cells)).alias("c")).groupBy("c.column", "c.value").agg(F.count("*").alias("n"))
    number = F.when(F.col("column").isin(*numbers), F.col("value")).try_cast("double")
    running = running_totals(counted.withColumn("number", number), ["column", "number", "value"], {"_through": "n"})
    running = materialize(running, "ranges")
    starts = running.groupBy("column").agg(F.min(F.col("_through") - F.col("n")).alias("_start"), F.sum("n").alias("rows"))
    found = running.join(starts, "column").select(
        "column", "value", (F.col("_through") - F.col("n") - F.col("_start")).alias("ahead"),
        (F.col("_through") - F.col("_start")).alias("through"),
    )
    n = starts.agg(F.max("rows")).first()[0] or 0
    return found, n


def synthetic_rows(
    df: DataFrame, key: str, columns: Sequence[str], num_rows: int = 10, seed: int = 42
) -> DataFrame:
    """Draw every column on its own from its observed values; ``key`` is a new unique text key.

    Inverse distribution: a draw is a place in the sorted column, and the value whose range holds the place. Draws meet
    ranges on blocks of places, so what is joined depends on the draws and on the number of values, not on the rows of ``df``.
    """
    ranges, n = value_ranges(df, columns)
    if not n:
        raise ValueError("no rows to draw from")
    step = max(1, n // BLOCKS)
    # A value covers at most BLOCKS blocks and one more.
    blocks = F.sequence(F.floor(F.col("ahead") / step), F.floor((F.col("through") - 1) / step))
    listed = ranges.withColumn("_block", F.explode(blocks))
    names = F.array(*[F.lit(c) for c in columns])
    picks = (
        df.sparkSession.range(num_rows)
        .select(F.col("id").alias("_row"), F.explode(names).alias("column"))
        .withColumn("_place", hash_number(F.col("_row"), F.col("column"), seed) % F.lit(n))
        .withColumn("_block", F.floor(F.col("_place") / step))
    )
    drawn = picks.join(listed, ["column", "_block"])
    drawn = drawn.where((F.col("_place") >= F.col("ahead")) & (F.col("_place") < F.col("through")))
    value = {c: F.max(F.when(F.col("column") == c, F.col("value"))).cast(df.schema[c].dataType) for c in columns}
    return (
        drawn.groupBy("_row")
        .agg(*[v.alias(c) for c, v in value.items()])
        .select(F.concat(F.lit(KEY_PREFIX), (F.col("_row") + KEY_FIRST).cast("string")).alias(key), *columns)
    )


def add_drift(
    synthetic: DataFrame,
    source: DataFrame,
    key: str,
    scaled: Sequence[str],
    year: str | None = None,
    factor: int = 2,
    seed: int = 42,
) -> DataFrame:
    """Multiply the ``scaled`` columns and move ``year`` to one or two years after the last one in ``source``."""
    changed = {c: F.col(c) * factor for c in scaled}
    if year is not None:
        last = source.agg(F.max(year)).scalar()
        step = hash_number(F.col(key), year, seed) % 2 + 1
        changed[year] = (last + step).cast(source.schema[year].dataType)
    return synthetic.withColumns(changed)
