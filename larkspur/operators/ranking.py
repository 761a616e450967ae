"""Exact ranks in hash order, found without sorting the table.

Rows are ordered by the MD5 of key and seed. Counting the rows per four-digit prefix gives at most 65,536 numbers per
class, and their running sum says in which prefix any rank lies. Only that prefix is then looked at closely. Classes,
their sizes and their cuts stay in tables, so there may be any number of them. The key must be unique, as the primary key
of a table is.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.hashing import row_hash
from larkspur.workspace import materialize

_PREFIXES = 65_536
_NO_CLASS = "all"
_NULL_CLASS = "∅"


@dataclass(frozen=True)
class RankIndex:
    """Row counts per class and hash prefix. ``classes`` holds each class, as text, and its row count ``_total``."""

    rows: DataFrame
    spans: DataFrame
    classes: DataFrame
    columns: tuple[str, ...]
    grouped: bool

    def total(self) -> int:
        """Rows in all."""
        return self.classes.agg(F.coalesce(F.sum("_total"), F.lit(0))).first()[0]

    def cut(self, ranks: Column, name: str = "part", classes: DataFrame | None = None) -> DataFrame:
        """Number the parts the rows fall into when each class is cut at the given ranks.

        ``ranks`` is an array of ascending row counts over the columns of ``classes``; the first part is 0. The result is
        the table with one more column, made by comparing each row's hash with its class's boundaries.
        """
        table = self.classes if classes is None else classes
        cuts = table.select("_class", "_total", F.posexplode(ranks).alias("_place", "_rank"))
        cuts = materialize(cuts.withColumn("_rank", F.col("_rank").cast("long")), "cuts")
        found = self._hashes(cuts.where((F.col("_rank") > 0) & (F.col("_rank") < F.col("_total"))))
        # Below every hash for rank 0, above every hash for the last one.
        edge = F.when(F.col("_rank") <= 0, "").when(F.col("_rank") >= F.col("_total"), "g").otherwise(F.col("_at"))
        edges = cuts.join(found, ["_class", "_rank"], "left").groupBy("_class")
        edges = edges.agg(F.array_sort(F.collect_list(F.struct("_place", edge.alias("edge")))).alias("_cuts"))
        edges = edges.select("_class", F.col("_cuts.edge").alias("_edges"))
        below = F.size(F.filter("_edges", lambda e: e < F.col("_hash")))
        if self.grouped:
            parts = self.rows.join(materialize(edges, "edges"), "_class")
        else:
            # One class: its few boundaries become literals, and no row moves.
            only = edges.first()
            parts = self.rows.withColumn(
                "_edges", F.array(*[F.lit(e) for e in (only["_edges"] if only else [])]).cast("array<string>")
            )
        return parts.select(*self.columns, below.alias(name))

    def _hashes(self, wanted: DataFrame) -> DataFrame:
        """``_at``, the hash of the r-th row of a class, for each wanted (``_class``, ``_rank``)."""
        inside = (F.col("_rank") > F.col("_ahead")) & (F.col("_rank") <= F.col("_ahead") + F.col("_n"))
        hit = self.spans.join(wanted.select("_class", "_rank").distinct(), "_class").where(inside)
        hit = materialize(hit.select("_class", "_prefix", "_ahead", "_rank"), "hit")
        # Copies of a key share a hash: they are counted, not listed.
        close = (
            self.rows.join(hit.select("_class", "_prefix").distinct(), ["_class", "_prefix"], "left_semi")
            .groupBy("_class", "_prefix", "_hash")
            .agg(F.count("*").alias("_copies"))
        )
        order = Window.partitionBy("_class", "_prefix").orderBy("_hash")
        through = F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, 0))
        at = (
            close.withColumn("_through", through)
            .join(hit, ["_class", "_prefix"])
            .withColumn("_through", F.col("_through") + F.col("_ahead"))
            .where((F.col("_rank") <= F.col("_through")) & (F.col("_rank") > F.col("_through") - F.col("_copies")))
            .select("_class", "_rank", F.col("_hash").alias("_at"), "_through")
        )
        at = materialize(at, "edges")
        if at.where("_through <> _rank").limit(1).count():
            raise ValueError("the key repeats where the table is to be cut; give a unique key")
        return at.drop("_through")

    def at_ranks(self, picks: DataFrame) -> DataFrame:
        """Join picks (``_class``, ``_rank`` from 0, anything else) with the rows that hold these ranks.

        Only prefixes that some pick falls into are read and numbered.
        """
        # Prefixes and picks meet on a block of ranks; an evenly filled prefix covers one or two blocks.
        blocks = self._with_step(self.spans).select(
            "_class",
            "_prefix",
            "_ahead",
            "_n",
            F.explode(F.expr("sequence(_ahead div _step, (_ahead + _n - 1) div _step)")).alias("_block"),
        )
        placed = (
            self._with_step(picks)
            .withColumn("_block", F.expr("_rank div _step"))
            .drop("_step")
            .join(blocks, ["_class", "_block"])
            .where((F.col("_rank") >= F.col("_ahead")) & (F.col("_rank") < F.col("_ahead") + F.col("_n")))
            .withColumn("_inner", F.col("_rank") - F.col("_ahead"))
            .drop("_block", "_ahead", "_n")
        )
        order = Window.partitionBy("_class", "_prefix").orderBy("_hash")
        numbered = (
            self.rows.join(placed.select("_class", "_prefix").distinct(), ["_class", "_prefix"], "left_semi")
            .withColumn("_inner", F.row_number().over(order).cast("long") - 1)
            .drop("_hash")
        )
        return placed.join(numbered, ["_class", "_prefix", "_inner"]).drop("_prefix", "_inner")

    def _with_step(self, df: DataFrame) -> DataFrame:
        """Add the number of ranks per block of the row's class."""
        if not self.grouped:
            # One class: a literal, so that nothing is joined on a constant.
            return df.withColumn("_step", F.lit(max(1, self.total() // _PREFIXES)).cast("long"))
        step = F.greatest(F.lit(1), F.expr(f"_total div {_PREFIXES}")).cast("long").alias("_step")
        return df.join(self.classes.select("_class", step), "_class")


def rank_index(df: DataFrame, keys: Sequence[str], seed: int, by: str | None = None) -> RankIndex:
    """Count the rows per class and prefix: one pass over the key and class columns."""
    label = F.lit(_NO_CLASS) if by is None else class_name(by)
    rows = df.withColumns({"_class": label, "_hash": row_hash(keys, seed)}).withColumn(
        "_prefix", F.substring("_hash", 1, 4)
    )
    counts = rows.groupBy("_class", "_prefix").agg(F.count("*").alias("_n"))
    ahead = Window.partitionBy("_class").orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    spans = materialize(counts.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))), "ranks")
    classes = materialize(spans.groupBy("_class").agg(F.sum("_n").alias("_total")), "classes")
    return RankIndex(rows, spans, classes, tuple(df.columns), by is not None)


def class_name(column: str) -> Column:
    """A class as text, null included."""
    return F.coalesce(F.col(column).cast("string"), F.lit(_NULL_CLASS))
