"""Exact top-k inner products by dual-tree cover-tree search, in blocks.

Vectors become whole numbers (floor of ``scale`` times each component), so scores are exact. Rows go to the nearest of a
few pivots (a bounded sample, which only decides the cells), large cells are split by hash, and each part becomes a
block with a cover tree: every node has a centre and a covering radius, and children cover theirs within half of it.
Queries become blocks with trees of their own. A score of a query under a query node and a row under a data node is at most

    <q, d> + |q| R_d + |d| R_q + R_q R_d        (centres q, d; radii R_q, R_d)

so a pair of nodes is left out when that is below the worst kth score of the query group.

Every query block first searches one block of its own cell, which gives its queries a kth score to start from. Then it
meets the centres and radii of all blocks, cell by cell; only pairs of blocks that the bound leaves possible are joined
and searched as two trees. Per query the best k of all blocks are kept. The stated queries meet all rows this way, in
blocks; blocks, not rows, are what the joins multiply.

Defined results: vectors that are null, empty or hold a null or non-finite component, and rows without an id, take no part;
only vectors of equal length meet. A query's own row is any row of its id. Equal scores go to the smaller id; repeated
candidates count each; repeated queries of one id and vector count once. Fewer than k candidates give fewer rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.workspace import materialize

LEAF = 32
BLOCK = 2048
QUERIES = 256
PIVOTS = 64


class CoverTree:
    """Nodes over rows that are reordered so that each node's rows stand together."""

    def __init__(self, points: np.ndarray):
        self.points = points
        self.order, self.nodes = [], []  # a node: centre, radius, its norm, first row, last row, children
        if len(points):
            self._grow(np.arange(len(points)), None)
        self.order = np.array(self.order, np.int64)

    def _grow(self, rows: np.ndarray, scale: float | None) -> int:
        centre = self.points[rows[0]]
        away = np.sqrt(((self.points[rows] - centre) ** 2).sum(axis=1))
        radius, first, number = float(away.max()), len(self.order), len(self.nodes)
        self.nodes.append(None)
        children: list[int] = []
        scale = radius / 2 if scale is None else min(scale, radius) / 2
        groups = self._cover(rows, scale) if len(rows) > LEAF and radius > 0 else []
        if groups and len(rows) >= 4 * len(groups):
            children = [self._grow(group, scale) for group in groups]
        else:
            self.order.extend(rows)
        norm = float(np.sqrt((centre**2).sum()))
        self.nodes[number] = (centre, radius, norm, first, len(self.order), children)
        return number

    def _cover(self, rows: np.ndarray, scale: float) -> list[np.ndarray]:
        """Groups of rows within ``scale`` of the first row that no earlier group has taken."""
        groups = []
        while len(rows):
            away = np.sqrt(((self.points[rows] - self.points[rows[0]]) ** 2).sum(axis=1))
            near = away <= scale
            groups.append(rows[near])
            rows = rows[~near]
            if len(groups) * 4 > len(self.points):
                return []
        return groups


class Best:
    """The best k (score, id) of each query so far, best first; ids of empty places are the largest number."""

    NONE = np.iinfo(np.int64).min
    LAST = np.iinfo(np.int64).max

    def __init__(self, n: int, k: int, worst: np.ndarray | None = None):
        self.k = k
        self.score = np.full((n, k), self.NONE)
        self.id = np.full((n, k), self.LAST)
        self.given = np.full(n, self.NONE) if worst is None else worst

    def worst(self, rows: np.ndarray) -> int:
        """The smallest score that a new candidate must reach for some of the queries."""
        return int(np.maximum(self.score[rows, -1], self.given[rows]).min())

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray, own: np.ndarray) -> None:
        score = np.where(ids[None, :] == own[:, None], self.NONE, score)
        ids = np.where(score == self.NONE, self.LAST, np.broadcast_to(ids, score.shape))
        score = np.concatenate([self.score[rows], score], axis=1)
        ids = np.concatenate([self.id[rows], ids], axis=1)
        order = np.lexsort((ids, -score.astype(np.float64) if abs(score).max() < 2**53 else ~score), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.id[rows] = np.take_along_axis(ids, order, 1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole vectors."""
    largest = float(abs(a).max(initial=0)) * float(abs(b).max(initial=0)) * a.shape[1]
    if largest < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def dual_search(queries: CoverTree, q_ids, q_whole, data: CoverTree, d_ids, d_whole, best: Best) -> None:
    """Update ``best`` (one row a query) by all data rows that may enter it."""
    if not queries.nodes or not data.nodes:
        return

    def bound(q, d) -> float:
        (qc, qr, qn, *_), (dc, dr, dn, *_) = queries.nodes[q], data.nodes[d]
        top = float(qc @ dc) + qn * dr + dn * qr + qr * dr
        return top + abs(top) * 1e-9 + 1e-6

    pending = [(bound(0, 0), 0, 0)]
    while pending:
        top, q, d = pending.pop()
        _, qr, _, q0, q1, q_children = queries.nodes[q]
        _, dr, _, d0, d1, d_children = data.nodes[d]
        rows = queries.order[q0:q1]
        if top < best.worst(rows):
            continue
        if not q_children and not d_children:
            mine = data.order[d0:d1]
            best.add(rows, _products(q_whole[rows], d_whole[mine]), d_ids[mine], q_ids[rows])
            continue
        if d_children and (dr >= qr or not q_children):
            more = [(bound(q, c), q, c) for c in d_children]
        else:
            more = [(bound(c, d), c, d) for c in q_children]
        pending += sorted(more)  # the most promising pair is taken first


def _vectors(column: pa.Array) -> np.ndarray:
    """A list column of whole numbers, all of one length."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _packed_block(ids: np.ndarray, whole: np.ndarray) -> dict:
    centre = whole.mean(axis=0) if len(whole) else np.zeros(whole.shape[1])
    radius = float(np.sqrt(((whole - centre) ** 2).sum(axis=1)).max()) if len(whole) else 0.0
    return {"ids": ids.tobytes(), "whole": whole.astype(np.int64).tobytes(), "centre": centre.tobytes(), "radius": radius}


_BLOCK = "dim int, cell int, part long, ids binary, whole binary, centre binary, radius double"


def _blocked(table: pa.Table) -> pa.Table:
    order = np.argsort(table["id"].to_numpy(), kind="stable")
    ids, whole = table["id"].to_numpy()[order], _vectors(table["whole"].combine_chunks())[order]
    row = {c: table[c][0].as_py() for c in ("dim", "cell", "part")} | _packed_block(ids, whole)
    return pa.Table.from_pylist([row], schema=_BLOCK_ARROW)


_BLOCK_ARROW = pa.schema(
    [("dim", pa.int32()), ("cell", pa.int32()), ("part", pa.int64()), ("ids", pa.binary()), ("whole", pa.binary()),
     ("centre", pa.binary()), ("radius", pa.float64())]
)


def _blocks(rows: DataFrame, rows_per_block: int) -> DataFrame:
    """Rows (dim, cell, id, whole) in blocks of about that size."""
    sizes = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / rows_per_block).cast("long").alias("parts"))
    dealt = rows.join(sizes, ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    dealt = dealt.select("dim", "cell", "part", "id", "whole")
    return dealt.groupBy("dim", "cell", "part").applyInArrow(_blocked, _BLOCK)


def _celled(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    """The nearest pivot of each row; pivots are few by their number."""
    spark = rows.sparkSession
    by_dim: dict[int, np.ndarray] = {}
    for row in pivots.collect():
        by_dim.setdefault(row.dim, []).append(row.whole)
    held = spark.sparkContext.broadcast({d: np.array(p, np.float64) for d, p in by_dim.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim = batch.column("dim").to_numpy()
            cell = np.zeros(len(dim), np.int32)
            for d in np.unique(dim):
                at = np.flatnonzero(dim == d)
                points = _vectors(batch.column("whole").take(pa.array(at))).astype(np.float64)
                near = held.value[int(d)]
                cell[at] = ((near**2).sum(axis=1)[None, :] - 2 * points @ near.T).argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("dim"), pa.array(cell), batch.column("id"), batch.column("whole")],
                names=["dim", "cell", "id", "whole"],
            )

    return rows.mapInArrow(run, "dim int, cell int, id long, whole array<bigint>")


def _unpacked(row: dict, side: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row[f"{side}ids"], np.int64)
    return ids, np.frombuffer(row[f"{side}whole"], np.int64).reshape(len(ids), -1)


def _search(k: int, thresholds: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of a query block and a data block: the best of each query there (or only the kth scores)."""
        trees: dict[str, tuple] = {}

        def tree(row: dict, side: str):
            key = (side, row[f"{side}dim"], row[f"{side}cell"], row[f"{side}part"])
            if trees.get(side, (None,))[0] != key:
                ids, whole = _unpacked(row, side)
                trees[side] = key, ids, whole, CoverTree(whole.astype(np.float64))
            return trees[side][1:]

        for batch in batches:
            for i in range(len(batch)):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                q_ids, q_whole, q_tree = tree(row, "q_")
                d_ids, d_whole, d_tree = tree(row, "")
                worst = None if thresholds or not row["q_worst"] else np.frombuffer(row["q_worst"], np.int64)
                best = Best(len(q_ids), k, worst)
                dual_search(q_tree, q_ids, q_whole, d_tree, d_ids, d_whole, best)
                if thresholds:
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array([row[f"q_{c}"]], t) for c, t in (("dim", pa.int32()), ("cell", pa.int32()), ("part", pa.int64()))),
                         pa.array([best.score[:, -1].tobytes()], pa.binary())],
                        names=["dim", "cell", "part", "worst"],
                    )
                    continue
                some = best.id != Best.LAST
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q_ids, k).reshape(some.shape)[some]), pa.array(best.id[some]), pa.array(best.score[some])],
                    names=["query_id", "id", "score"],
                )

    return run


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of blocks that may hold a better row for some query."""
    for batch in batches:
        keep = []
        for i in range(len(batch)):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            _, whole = _unpacked(row, "q_")
            centre = np.frombuffer(row["centre"], np.float64)
            norms = np.sqrt((whole.astype(np.float64) ** 2).sum(axis=1))
            top = whole @ centre + norms * row["radius"]
            worst = np.frombuffer(row["q_worst"], np.int64) if row["q_worst"] else np.full(len(whole), Best.NONE)
            keep.append(bool((top + abs(top) * 1e-9 + 1e-6 >= worst).any()))
        mask = pa.array(keep, pa.bool_())
        names = ["q_dim", "q_cell", "q_part", "cell", "part"]
        yield pa.RecordBatch.from_arrays([batch.column(n).filter(mask) for n in names], names=names)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), id and score of each query's k best rows; ``is_query`` is a condition on a column ``id``."""
    parts = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall("parts", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), parts.alias("parts"))
    rows = rows.where(F.col("id").isNotNull() & F.col("parts").isNotNull() & (F.size("parts") > 0)).where(fine)
    rows = rows.select(
        F.size("parts").alias("dim"), "id", F.transform("parts", lambda x: F.floor(scale * x).cast("long")).alias("whole")
    )
    few = rows.withColumn("mixed", F.xxhash64("id", F.lit("pivot")))
    pivots = few.groupBy("dim").agg(F.min_by("whole", F.struct("mixed", "id")).alias("whole"))
    sample = few.orderBy("mixed", "id").limit(PIVOTS).select("dim", "whole")
    pivots = sample.union(pivots.select("dim", "whole"))
    celled = materialize(_celled(rows, pivots), "celled")
    data = materialize(_blocks(celled, BLOCK), "data")
    asked = celled.where(is_query).dropDuplicates(["id", "whole"])
    asked = materialize(_blocks(asked, QUERIES), "queries")
    asked = asked.select(*(F.col(c).alias(f"q_{c}") for c in asked.columns))

    # One block of its own cell gives each query block a first kth score.
    home = data.groupBy("dim", "cell").agg(F.min("part").alias("part")).withColumnsRenamed({"dim": "q_dim", "cell": "q_cell"})
    own = asked.join(home, ["q_dim", "q_cell"]).withColumns({"dim": F.col("q_dim"), "cell": F.col("q_cell")})
    own = own.join(data.select("dim", "cell", "part", "ids", "whole"), ["dim", "cell", "part"])
    own = own.withColumn("q_worst", F.lit(None).cast("binary"))
    worst = own.mapInArrow(_search(k, True), "dim int, cell int, part long, worst binary")
    worst = worst.select(*(F.col(c).alias(f"q_{c}") for c in worst.columns))
    asked = materialize(asked.join(worst, ["q_dim", "q_cell", "q_part"], "left"), "asked")

    # Every query block against the centres of all blocks, cell by cell.
    cells = data.groupBy("dim").agg(F.collect_set("cell").alias("cells")).withColumnRenamed("dim", "q_dim")
    sent = asked.join(cells, "q_dim").withColumn("cell", F.explode("cells"))
    outline = data.select(F.col("dim").alias("q_dim"), "cell", "part", "centre", "radius")
    met = sent.drop("cells").join(outline, ["q_dim", "cell"])
    pairs = materialize(met.mapInArrow(_possible, "q_dim int, q_cell int, q_part long, cell int, part long"), "pairs")
    both = pairs.withColumn("dim", F.col("q_dim")).join(asked, ["q_dim", "q_cell", "q_part"])
    both = both.join(data.select("dim", "cell", "part", "ids", "whole"), ["dim", "cell", "part"])
    found = both.select("q_dim", "q_cell", "q_part", "q_ids", "q_whole", "q_worst", "dim", "cell", "part", "ids", "whole")
    found = found.mapInArrow(_search(k, False), "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", F.col("id").alias(id_col), "score"
    )
