"""Connected components of links kept in tables: batches are contracted, then labels spread to the smallest neighbour."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.workspace import materialize


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of a batch as links of each node to the smallest node it is connected with there."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int, parent: dict[int, int] = parent) -> int:
            top = x
            while parent.setdefault(top, top) != top:
                top = parent[top]
            while parent[x] != top:
                parent[x], x = top, parent[x]
            return top

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(a), root(b)
            if a != b:
                parent[max(a, b)] = min(a, b)
        far = [(x, root(x)) for x in list(parent)]
        far = [(x, r) for x, r in far if x != r]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in far], pa.int64()), pa.array([r for _, r in far], pa.int64())], names=["u", "v"]
        )


def _written(links: DataFrame) -> tuple[DataFrame, tuple]:
    """Links contracted by batch, without repeats, as a table, and what tells one such table from another."""
    edges = materialize(links.mapInArrow(_contracted, "u long, v long").distinct(), "links")
    sign = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return edges, tuple(edges.agg(F.count("*"), sign).first())


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; the component is its smallest node.

    Each round replaces the links by links to the smallest neighbour: every node points its larger neighbours, then its
    smaller ones, at the smallest of them. Rounds grow with the logarithm of the longest path. Each round is a written
    table, so a lost executor costs a re-read; a hot node is an aggregation that is reduced before the shuffle and a
    join that adaptive execution splits. No links gives an empty table.
    """
    edges, before = _written(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v"))
    while True:
        # Large star: larger neighbours of u are linked to the smallest of u and its neighbours.
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Small star: smaller neighbours of u, and u, are linked to the smallest of them.
        down = large.where("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        upper = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = down.join(least, "u").select(upper.alias("u"), F.col("m").alias("v")).where("u <> v")
        edges, after = _written(small)
        # Settled when every node has one link, to its component.
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots).distinct()
