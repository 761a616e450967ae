"""Order across the whole cluster: positions, running totals and exact quantiles without a one-task sort.

A range-partitioned sort is written once. Each of its partitions is a *slice*; the id Spark gives a row carries the
slice and the place in it. Totals per slice are one row per partition, so the offsets in front of each slice are a tiny
table, and the rest of the work stays inside the slices. Boundaries come from sampling, so they follow the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.workspace import materialize

_PLACE_BITS = 33
_BEFORE = (Window.unboundedPreceding, -1)


def _sliced(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Sorted rows with ``_slice`` and ``_place``, written so that both stay fixed."""
    numbered = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    written = materialize(numbered, "sorted")
    return written.withColumn("_slice", F.shiftright("_id", _PLACE_BITS)).withColumn(
        "_place", F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    )


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Number the rows 0..n-1 in the given order."""
    rows = _sliced(df, order)
    ahead = Window.orderBy("_slice").rowsBetween(*_BEFORE)
    offsets = (
        rows.groupBy("_slice")
        .agg(F.count("*").alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_ahead"))
    )
    # One row per sorted partition, whatever the size of the data.
    return (
        rows.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_place") + F.col("_ahead"))
        .drop("_slice", "_place", "_id", "_ahead")
    )


def running_totals(df: DataFrame, order: Sequence[Column | str], totals: Mapping[str, str]) -> DataFrame:
    """Add cumulative sums in the given order: ``totals`` maps each new column to the column of whole numbers it adds up.

    One shuffle: a task adds up its slice as it comes out of the sort. The order should leave no large ties: group by the
    ordering columns first.
    """
    names = list(df.columns)
    places = [names.index(source) for source in totals.values()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far, own = [0] * len(places), TaskContext.get().partitionId()
        for batch in batches:
            added = []
            for i, place in enumerate(places):
                through = np.cumsum(batch.column(place).fill_null(0).to_numpy().astype(np.int64)) + so_far[i]
                so_far[i] = int(through[-1]) if len(through) else so_far[i]
                added.append(pa.array(through))
            added.append(pa.array(np.full(batch.num_rows, own, np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*names, *totals, "_slice"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema]
    schema = ", ".join([*kinds, *(f"`{new}` long" for new in totals), "_slice int"])
    rows = materialize(df.orderBy(*order).mapInArrow(run, schema), "running")
    ahead = Window.orderBy("_slice").rowsBetween(*_BEFORE)
    offsets = (
        rows.groupBy("_slice")
        .agg(*[F.sum(source).alias(new) for new, source in totals.items()])
        .select("_slice", *[F.coalesce(F.sum(new).over(ahead), F.lit(0)).alias(f"_ahead_{new}") for new in totals])
    )
    # One row per sorted partition.
    return (
        rows.join(F.broadcast(offsets), "_slice")
        .withColumns({new: F.col(new) + F.col(f"_ahead_{new}") for new in totals})
        .drop("_slice", *[f"_ahead_{new}" for new in totals])
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """Interpolated quantiles of several columns in one pass, nulls ignored.

    Values are counted before they are sorted; no task holds a column, unlike the built-in exact percentile.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counted = (
        df.select(F.explode(pairs).alias("p"))
        .select("p.*")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    running = running_totals(counted, ["column", "value"], {"through": "n"})
    # The running count goes through the columns in name order, so their sizes say where each begins.
    sizes = {r["column"]: r["size"] for r in running.groupBy("column").agg(F.sum("n").alias("size")).collect()}
    bounds, first = {}, 0
    for c in sorted(sizes):
        bounds[c] = (first, first + sizes[c])
        first += sizes[c]
    wanted, aggregates = {}, []
    for c, (first, last) in bounds.items():
        for i, share in enumerate(shares):
            place = (last - first - 1) * share
            low = int(place)
            wanted[c, i] = place - low
            for step in (0, 1):
                hit = (F.col("column") == c) & (F.col("through") > first + min(low + step, last - first - 1))
                aggregates.append(F.min(F.when(hit, F.col("value"))).alias(f"{len(wanted)}_{step}"))
    if not aggregates:
        return {c: [None] * len(shares) for c in columns}
    row = running.agg(*aggregates).first()
    result: dict[str, list[float | None]] = {c: [None] * len(shares) for c in columns}
    for at, ((c, i), part) in enumerate(wanted.items(), start=1):
        low, high = row[f"{at}_0"], row[f"{at}_1"]
        result[c][i] = low + part * (high - low)
    return result


def approximate_quantiles(
    df: DataFrame, columns: Sequence[str], shares: Sequence[float], accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """Quantile sketches of several columns in one aggregation."""
    row = df.agg(
        *[F.approx_percentile(F.col(c).cast("double"), list(shares), accuracy).alias(c) for c in columns]
    ).first()
    return {c: list(row[c]) if row[c] is not None else [None] * len(shares) for c in columns}
