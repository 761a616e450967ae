"""Lookup, point-in-time and label joins.

Plain equi-joins carry no hint: adaptive execution broadcasts a side it has measured as small and splits skewed keys.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.workspace import materialize


@dataclass(frozen=True)
class Lookup:
    """Features wanted from one table. ``base_keys`` name the key columns in the base rows when they differ."""

    table: DataFrame
    features: Sequence[str]
    keys: Sequence[str]
    base_keys: Sequence[str] = ()
    time: str | None = None

    def base_names(self) -> list[str]:
        return list(self.base_keys or self.keys)


def fuse(lookups: Sequence[Lookup]) -> list[Lookup]:
    """One lookup per (table, key) instead of one per feature. Two DataFrames of one table count as that table."""
    fused: list[Lookup] = []
    for one in lookups:
        for i, have in enumerate(fused):
            same_key = (list(have.keys), have.base_names(), have.time) == (list(one.keys), one.base_names(), one.time)
            if same_key and (have.table is one.table or have.table.sameSemantics(one.table)):
                features = list(dict.fromkeys([*have.features, *one.features]))
                fused[i] = Lookup(have.table, features, have.keys, have.base_keys, have.time)
                break
        else:
            fused.append(one)
    return fused


def training_set(
    base: DataFrame,
    lookups: Sequence[Lookup],
    label: str | None = None,
    exclude: Sequence[str] = (),
    time: str | None = None,
) -> DataFrame:
    """Base rows with their features: as many rows as the base, a missing key gives nulls, the label comes last.

    The keys of a lookup table must be unique; ``feature_table.check_keys`` tells.

    With ``time`` (base column) and a lookup's own ``time``, the features are those valid at that moment.
    """
    rows = base
    for one in fuse(lookups):
        taken = set(rows.columns) & set(one.features)
        if taken:
            raise ValueError(f"features {sorted(taken)} are already in the base rows")
        if time is not None and one.time is not None:
            rows = as_of_join(rows, one.table, one.base_names(), time, one.time, one.features, one.keys)
            continue
        names = dict(zip(one.keys, one.base_names(), strict=True))
        side = one.table.select(*one.keys, *one.features).withColumnsRenamed(names)
        rows = rows.join(side, one.base_names(), "left")
    columns = [c for c in rows.columns if c not in exclude and c != label]
    return rows.select(*columns, *([label] if label else []))


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int) -> tuple[DataFrame, int, int]:
    """Keys with more than ``rows`` rows, how many they are, and the rows of the largest.

    There are at most (all rows / ``rows``) of them. The count is reduced on the map side.
    """
    found = materialize(df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > rows), "hot")
    n, largest = found.agg(F.count("*"), F.coalesce(F.max("_n"), F.lit(0))).first()
    return found.select(*keys), n, largest


def as_of_join(
    base: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    base_time: str,
    feature_time: str,
    columns: Sequence[str],
    feature_keys: Sequence[str] = (),
    hot_rows: int = 5_000_000,
) -> DataFrame:
    """For each base row the newest feature row of its key at or before the base time; null when there is none.

    Base and features are sorted together per key, so there is no range join. Of a key with more than ``hot_rows`` rows only the
    moments are sorted, each once, with the last feature of each; base rows get the answer of their moment by a join. Where
    the moments are too many as well, they are sorted in pieces of time on many tasks, and the last feature of each piece is
    carried to that key's later pieces.
    """
    feature_keys = list(feature_keys or keys)
    # Rows without key or time match nothing and need no sorting.
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*keys, base_time)])
    unmatched = base.where(~complete)
    base, features = base.where(complete), features.dropna(subset=[*feature_keys, feature_time])
    side = features.select(
        *[F.col(f).alias(k) for f, k in zip(feature_keys, keys, strict=True)],
        F.col(feature_time).cast("timestamp").alias("_time"),
        F.lit(0).alias("_kind"),
        # The columns settle ties between features of the same moment.
        F.struct(F.col(feature_time).cast("timestamp").alias("_at"), *columns).alias("_feature"),
    )
    asked = base.select(
        *keys, F.col(base_time).cast("timestamp").alias("_time"), F.lit(1).alias("_kind"), F.struct(*base.columns).alias("_base")
    )
    hot, n_hot, _ = hot_keys(side.select(*keys).unionByName(asked.select(*keys)), keys, hot_rows)
    if not n_hot:
        found = _answered(side.unionByName(asked, allowMissingColumns=True), keys)
    else:
        few, many = (df.join(hot, list(keys), "left_anti") for df in (side, asked)), asked.join(hot, list(keys), "left_semi")
        cold = _answered(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), few), keys)
        moments = _hot_moments(side, asked, keys, hot, hot_rows)
        answers = _answered(moments, [*keys, "_piece"]).select(*keys, "_time", "_found")
        found = cold.select("_base", "_found").unionByName(
            many.join(answers, [*keys, "_time"], "left").select("_base", "_found")
        )
    found = found.select("_base.*", *[F.col(f"_found.{c}").alias(c) for c in columns])
    return found.unionByName(unmatched, allowMissingColumns=True)


def _answered(both: DataFrame, group: Sequence[str]) -> DataFrame:
    """The asked rows with ``_found``, the newest feature of their group up to their time."""
    order = Window.partitionBy(*group).orderBy("_time", "_kind", "_feature")
    newest = F.last("_feature", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("_found", newest).where(F.col("_kind") == 1)


def _hot_moments(side: DataFrame, asked: DataFrame, keys: Sequence[str], hot: DataFrame, hot_rows: int) -> DataFrame:
    """The moments of hot keys, each asked once and with one feature, in pieces of fewer than about ``hot_rows``.

    Both are aggregations, reduced before the shuffle: a moment that holds most rows of a key is two rows.
    """
    last = side.join(hot, list(keys), "left_semi").groupBy(*keys, "_time", "_kind").agg(F.max("_feature").alias("_feature"))
    times = asked.join(hot, list(keys), "left_semi").select(*keys, "_time", "_kind").distinct()
    both = last.unionByName(times, allowMissingColumns=True).withColumn("_piece", F.lit(0.0))
    still, n_still, largest = hot_keys(both, keys, hot_rows)
    return _in_pieces(both, keys, still, pieces=1 + 4 * largest // hot_rows) if n_still else both


def _in_pieces(both: DataFrame, keys: Sequence[str], hot: DataFrame, pieces: int) -> DataFrame:
    """Give the rows of hot keys a piece of time each, and add the feature carried into every piece.

    Every hot key is cut at quantiles of its own times, so keys in separate ranges are all cut.
    """
    seconds, shares = F.col("_time").cast("double"), [i / pieces for i in range(1, pieces)]
    timed = both.join(hot, list(keys), "left_semi").groupBy(*keys)
    edges = materialize(timed.agg(F.approx_percentile(seconds, shares, 10 * pieces).alias("_edges")), "edges")
    marked = both.join(edges, list(keys), "left")
    piece = F.size(F.filter("_edges", lambda e: e <= seconds)).cast("double")
    placed = (
        marked.withColumn("_hot", F.col("_edges").isNotNull())
        .withColumn("_piece", F.when(F.col("_hot"), piece).otherwise(F.lit(0.0)))
        .drop("_edges")
    )
    # At most `pieces` rows per hot key, reduced before the shuffle.
    newest = placed.where("_hot").groupBy(*keys, "_piece").agg(F.max("_feature").alias("_newest"))
    earlier = Window.partitionBy(*keys).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        newest.withColumn("_feature", F.last("_newest", ignorenulls=True).over(earlier))
        .where(F.col("_feature").isNotNull())
        .select(*keys, F.col("_feature._at").alias("_time"), F.lit(0).alias("_kind"), "_feature", "_piece")
    )
    return placed.drop("_hot").unionByName(carried, allowMissingColumns=True)


def attach_label(df: DataFrame, sources: Sequence[DataFrame], key: str, label: str, name: str = "status") -> DataFrame:
    """Left-join the label from several sources; the first source with a non-null label wins.

    The sources become one table with one label per key, so a repeated key cannot multiply rows, and one join is enough.
    """
    marked = [
        source.select(key, F.lit(i).alias("_source"), F.col(label).alias(name)) for i, source in enumerate(sources)
    ]
    # One plain column per source keeps this a hash aggregation, reduced before the shuffle.
    picks = [F.min(F.when(F.col("_source") == i, F.col(name))) for i in range(len(sources))]
    labels = reduce(DataFrame.unionByName, marked).groupBy(key).agg(F.coalesce(*picks).alias(name))
    return df.join(labels, key, "left")
