"""Exact nearest neighbours, used by SMOTE and by the neighbour vote.

The data are cut into cells around a few pivot rows and stored as blocks, each of one cell and one range of distances from
its pivot: arrays in the shared folder, written once. Queries are stored the same way; a task takes some queries of one
cell, searches that cell's blocks and then the others, nearest first, and keeps k rows per query. The k-th distance so far
closes blocks that cannot hold a neighbour, by the triangle inequality (the pruning of Lu et al., "Efficient processing of k
nearest neighbor joins using MapReduce", 2012) and by the plane between their pivot and the query's. The number of pivots
grows with the root of the data. Blocks and the queries of a task have a bounded number of rows whatever the shape of the
data. What is shuffled and written is each row once, and k rows per query, however many blocks a query visits; a task reads
the blocks it visits one at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.hashing import hash_number, row_hash
from larkspur.operators.ranking import class_name, rank_index
from larkspur.operators.resample import draws
from larkspur.store import load, save
from larkspur.workspace import materialize, new_path

_DATA_ROWS = 8_192
_QUERY_ROWS = 2_048
_PIVOTS = 256
_CELLS = 100_000
#: Rows of a group that are worth a cell.
_CELL_ROWS = 500
#: Distances a task holds at once.
_HELD = 1 << 21
#: Candidates whose distances are measured at once.
_MEASURED = 1 << 16
#: Rows that are sorted into blocks by one task.
_SORTED = 1 << 16
#: Squares below which distances are compared as short floats first.
_SHORT = 1e30
_ONE = "all"


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 0))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(1)[:, None] + (b**2).sum(1)[None, :] - 2.0 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))


class _Block:
    """Rows of one cell: ids and vectors."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        self.ids, self.points = ids, points

    def __len__(self) -> int:
        return len(self.ids)

    def __getitem__(self, rows: slice | np.ndarray) -> _Block:
        return _Block(self.ids[rows], self.points[rows])

    @classmethod
    def read(cls, path: str, name: str) -> _Block:
        table = pa.ipc.open_stream(pa.py_buffer(load(path, name, np.uint8))).read_all()
        vectors = table["vector"].combine_chunks()
        points = vectors.flatten().to_numpy().reshape(len(table), vectors.type.list_size)
        return cls(table["id"].to_pandas().to_numpy(), points)

    @staticmethod
    def write(path: str, name: str, rows: pa.Table) -> None:
        if rows["vector"].null_count:
            raise ValueError("a vector is null")
        vectors = rows["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)
        fixed = pa.FixedSizeListArray.from_arrays(pa.array(vectors.astype(np.float64).ravel()), vectors.shape[1])
        table = pa.table({"id": rows["id"].combine_chunks(), "vector": fixed})
        out = pa.BufferOutputStream()
        with pa.ipc.new_stream(out, table.schema) as writer:
            writer.write_table(table)
        save(path, name, np.frombuffer(out.getvalue(), np.uint8))


def _codes(ids: np.ndarray) -> np.ndarray:
    """Numbers in the order of the ids, null last."""
    codes = pd.factorize(ids, sort=True)[0]
    return np.where(codes < 0, len(ids), codes)


class _Asked:
    """Some queries of one cell, with the k nearest rows of each so far."""

    def __init__(self, queries: _Block, k: int, same: bool, centre: np.ndarray):
        self.queries, self.k, self.same, self.centre = queries, k, same, centre
        self.distance = np.full((len(queries), k), np.inf)
        self.neighbour: np.ndarray | None = None

    @property
    def limit(self) -> np.ndarray:
        """The k-th distance of each query so far."""
        return self.distance[:, -1]

    def add(self, rows: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        """Let found rows in: query, distance and id of each."""
        if self.neighbour is None:
            self.neighbour = np.empty(self.distance.shape, ids.dtype)
        elif self.neighbour.dtype != ids.dtype:
            self.neighbour = self.neighbour.astype(np.result_type(self.neighbour, ids))
        touched = np.unique(rows)
        old, place = np.nonzero(np.isfinite(self.distance[touched]))
        old = touched[old]
        rows = np.concatenate([rows, old])
        distance = np.concatenate([distance, self.distance[old, place]])
        ids = np.concatenate([ids, self.neighbour[old, place]])
        order = np.lexsort((ids if ids.dtype != object else _codes(ids), distance, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        best = rank < self.k
        at = rows[best], rank[best]
        self.distance[at], self.neighbour[at] = distance[order][best], ids[order][best]

    def found(self) -> pd.DataFrame:
        rows, place = np.nonzero(np.isfinite(self.distance))
        if not len(rows):
            return pd.DataFrame({"id": [], "neighbour": [], "distance": []})
        return pd.DataFrame(
            {"id": self.queries.ids[rows], "neighbour": self.neighbour[rows, place], "distance": self.distance[rows, place]}
        )


def _top_k(asked: _Asked, data: _Block, rows: np.ndarray) -> None:
    """Let the data rows into the k nearest of the queries ``rows``, by distance and then id; a row is not its own neighbour."""
    queries, k = asked.queries[rows], asked.k
    a, b = queries.points - asked.centre, data.points - asked.centre
    own, other = (a**2).sum(1), (b**2).sum(1)
    # Squares in short floats where they hold them, plus what rounding may have added: rows that it may have put on either
    # side of the limit are measured again.
    reach = (np.sqrt(own) + np.sqrt(np.fmax.reduce(other))) ** 2
    kind = np.float32 if np.fmax.reduce(reach) < _SHORT else np.float64
    rounding = 4 * (a.shape[1] + 8) * float(np.finfo(kind).eps) * reach + (float(np.finfo(kind).tiny) * 100)
    near = np.column_stack([-2.0 * a, own, np.ones(len(a))]).astype(kind) @ np.column_stack([b, np.ones(len(b)), other]).astype(kind).T
    limit = asked.limit[rows] ** 2
    begun = np.flatnonzero(np.isinf(limit))
    if len(begun):
        some = near[begun]
        if asked.same:
            some[queries.ids[begun][:, None] == data.ids[None, :]] = np.inf
        take = min(k, len(data))
        limit[begun] = np.partition(some, take - 1, axis=1)[:, take - 1] + rounding[begun] if take == k else np.inf
    inside = near <= (limit * (1 + 1e-6) + rounding).astype(kind)[:, None]
    found = np.flatnonzero(inside)
    for first in range(0, len(found), _MEASURED):
        i, j = np.divmod(found[first : first + _MEASURED], len(data))
        if asked.same:
            other_row = queries.ids[i] != data.ids[j]
            i, j = i[other_row], j[other_row]
        if len(i):
            distance = np.sqrt(((queries.points[i] - data.points[j]) ** 2).sum(1))
            asked.add(rows[i], distance, data.ids[j])


def nearest(queries: DataFrame, data: DataFrame, k: int, same: bool = False) -> DataFrame:
    """``id, neighbour, distance, rank`` of the k nearest data rows of each query row.

    Both tables have ``id`` (unique), ``vector`` (array of numbers) and optionally ``group``: neighbours are then looked
    for in the query's own group. With ``same`` both are one table and a row does not count as its own neighbour.
    """
    spark = data.sparkSession
    own_type, other_type = (d.schema["id"].dataType.simpleString() for d in (queries, data))
    pairs = f"id {own_type}, neighbour {other_type}, distance double"
    if "group" not in data.columns:
        queries, data = queries.withColumn("group", F.lit(_ONE)), data.withColumn("group", F.lit(_ONE))
    shape = ["group", "id", F.col("vector").cast("array<double>").alias("vector")]
    queries, data = (d.where("group IS NOT NULL").select(*shape) for d in (queries, data))
    total, groups = data.agg(F.count("*"), F.count_distinct("group")).first()
    if total == 0:
        return spark.createDataFrame([], f"{pairs}, rank int")
    if groups > _CELLS:
        raise ValueError("too many groups for a neighbour search")
    wanted = max(1, min(max(_PIVOTS, math.isqrt(total)), total // (_CELL_ROWS * groups), _CELLS // groups))
    pivots = _pivots(data, wanted, total)
    rows_at_once = max(1, _HELD // wanted)

    @F.pandas_udf("cell int, gap double")
    def home(vectors: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in vectors:
            cells, gaps = [np.zeros(0, np.int32)], [np.zeros(0)]
            for first in range(0, len(batch), rows_at_once):
                away = _distances(_matrix(batch.iloc[first : first + rows_at_once]), pivots)
                cell = away.argmin(1)
                cells.append(cell.astype(np.int32))
                gaps.append(away[np.arange(len(cell)), cell])
            yield pd.DataFrame({"cell": np.concatenate(cells), "gap": np.concatenate(gaps)})

    def stored(rows: DataFrame, path: str) -> DataFrame:
        placed = materialize(rows.withColumn("h", home("vector")).select("*", "h.*").drop("h"), "cells")
        return _blocks(placed, path, _DATA_ROWS)

    path = new_path(spark, "blocks")
    listed = stored(data, path)
    asked_path = path if same else new_path(spark, "blocks")
    asked_list = listed if same else stored(queries, asked_path)
    # One row per block: at most the cells, whose number is bounded, and one for some thousand rows.
    tables = _block_tables(listed)
    piece = min(_QUERY_ROWS, rows_at_once)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for group, cell, name, start in batch.itertuples(index=False):
                if group not in tables:
                    continue
                names, cells, low, high = tables[group]
                asked = _Asked(_Block.read(asked_path, name)[start : start + piece], k, same, pivots[cell])
                least = _least(asked.queries.points, pivots, cell, cells, low, high)
                # The own cell first: what it holds bounds the others.
                for b in np.lexsort((least.mean(0), cells != cell)):
                    rows = np.flatnonzero(~(least[:, b] > _slack(asked.limit)))
                    if len(rows):
                        data = _Block.read(path, names[b])
                        step = max(1, _HELD // len(rows))
                        for first in range(0, len(data), step):
                            _top_k(asked, data[first : first + step], rows)
                yield asked.found()

    pieces = asked_list.select("group", "cell", "name", F.explode(F.expr(f"sequence(0, n - 1, {piece})")).alias("start"))
    most = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 16 * spark.sparkContext.defaultParallelism)
    pieces = pieces.repartition(max(1, min(most, pieces.count())))
    found = materialize(pieces.mapInPandas(search, pairs), "near")
    order = Window.partitionBy("id").orderBy("distance", "neighbour")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _pivots(data: DataFrame, wanted: int, total: int) -> np.ndarray:
    """The vectors of the first rows in hash order."""
    found = _first_rows(_likely(data, wanted, total), wanted)
    if len(found) < min(wanted, total):
        # Copies of an id share a hash.
        found = _first_rows(data, wanted)
    return _matrix(found)


def _first_rows(data: DataFrame, n: int) -> pd.Series:
    return data.orderBy(row_hash(["id"], 0), "id").limit(n).select("vector").toPandas()["vector"]


def _likely(data: DataFrame, wanted: int, total: int) -> DataFrame:
    """Rows that may be among the first in hash order, about twice as many: each task sends its first rows to the driver."""
    below = int((2 * wanted + 100) / total * 16**8)
    return data.where(F.substring(row_hash(["id"], 0), 1, 8) < f"{below:08x}") if below < 16**8 else data


def _blocks(placed: DataFrame, path: str, size: int) -> DataFrame:
    """Write rows as blocks of one group and cell and at most ``size`` rows, by distance from the pivot. One row a block:
    ``group, cell, name, n, low, high``, the last two the least and largest of these distances."""
    rows = placed.count()
    tasks = max(rows // _SORTED, min(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // size))
    key = ["group", "cell", "gap"]
    ordered = placed.repartitionByRange(max(1, tasks), *key, F.xxhash64("id")).sortWithinPartitions(*key, "id")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = []
        part = TaskContext.get().partitionId()

        def flush(parts: list[pa.RecordBatch]) -> None:
            rows = pa.Table.from_batches(parts)
            for first in range(0, len(rows), size):
                some = rows.slice(first, size)
                gaps = some["gap"].to_numpy()
                name = f"{part}-{len(made)}"
                _Block.write(path, name, some)
                made.append((some["group"][0].as_py(), some["cell"][0].as_py(), name, len(some), gaps.min(), gaps.max()))

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not len(batch):
                continue
            names, cells = batch.column("group").to_numpy(zero_copy_only=False), batch.column("cell").to_numpy()
            edges = np.flatnonzero((names[1:] != names[:-1]) | (cells[1:] != cells[:-1])) + 1
            if held and (held[-1]["group"][-1].as_py(), held[-1]["cell"][-1].as_py()) != (names[0], cells[0]):
                flush(held)
                held = []
            for first, last in zip([0, *edges], [*edges, len(batch)], strict=True):
                if first:
                    flush(held)
                    held = []
                held.append(batch.slice(first, last - first))
            # A large cell is written as it comes.
            while sum(map(len, held)) > 2 * size:
                rows = pa.Table.from_batches(held).combine_chunks()
                whole = len(rows) // size * size
                flush(rows.slice(0, whole).to_batches())
                held = rows.slice(whole).to_batches()
        if held:
            flush(held)
        columns = zip(*made, strict=True) if made else [[]] * 6
        types = (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["group", "cell", "name", "n", "low", "high"]
        )

    return materialize(
        ordered.mapInArrow(write, "group string, cell int, name string, n int, low double, high double"), "listed"
    )


def _block_tables(listed: DataFrame) -> dict[str, tuple]:
    """Per group: name, cell, least and largest distance from the pivot of its blocks."""
    found = listed.toPandas()
    return {
        group: (some["name"].tolist(), *(some[c].to_numpy() for c in ("cell", "low", "high"))) for group, some in found.groupby("group")
    }


def _slack(limit):
    """A bound, and what rounding may have taken from it."""
    return limit * (1 + 1e-9) + 1e-6


def _least(points: np.ndarray, pivots: np.ndarray, cell: int, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """For queries of one cell and all blocks: a distance below which the block has no row."""
    away = _distances(points, pivots)
    own, near = away[:, cells], away[:, cell]
    least = np.maximum(own - high, low - own)
    # A row of another cell is no nearer to the query's pivot than to its own: it lies beyond the plane between them.
    between = _distances(pivots[[cell]], pivots)[0][cells]
    sizes = np.sqrt((pivots**2).sum(1))
    rounding = 1e-12 * ((near + sizes[cell]) ** 2 + sizes.max() ** 2)[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (own**2 - near[:, None] ** 2 - rounding) / (2 * between)
    return np.maximum(least, np.where(between**2 > rounding, plane, 0.0), out=least)


def smote(
    df: DataFrame, target: str, key: str, vector: str, k: int = 5, seed: int = 42
) -> DataFrame:
    """New rows that raise every class to the size of the largest: ``target``, ``key`` and ``neighbour`` of the two rows
    each new one lies between, ``share`` of the way, and the new ``vector``.

    Synthetic minority over-sampling (Chawla et al., 2002) with exact neighbours inside the class.
    """
    index = rank_index(df.select(key, target, vector), [key], seed, by=target)
    top = index.classes.agg(F.coalesce(F.max("_total"), F.lit(0))).first()[0]
    small = index.classes.where(F.col("_total") < top)
    short = small.where(F.col("_total") <= k).limit(5).collect()
    if short:
        raise ValueError(f"classes {[r['_class'] for r in short]} have no {k} neighbours")
    picks = draws(small.withColumn("_k", F.lit(top) - F.col("_total"))).select(
        "_class",
        (hash_number(F.col("_class"), F.col("_draw"), seed, "row") % F.col("_total")).alias("_rank"),
        (hash_number(F.col("_class"), F.col("_draw"), seed, "near") % k + 1).cast("int").alias("rank"),
        (hash_number(F.col("_class"), F.col("_draw"), seed, "gap") / float(1 << 60)).alias("share"),
    )
    chosen = index.at_ranks(picks)
    minority = (
        df.withColumn("_class", class_name(target))
        .join(small.select("_class"), "_class", "left_semi")
        .select(
            F.col(key).alias("id"),
            F.col(vector).cast("array<double>").alias("vector"),
            F.col(target).cast("string").alias("group"),
        )
    )
    near = nearest(minority, minority, k, same=True).select(
        F.col("id").alias(key), "rank", "neighbour"
    )
    other = minority.select(F.col("id").alias("neighbour"), F.col("vector").alias("_other"))
    between = F.zip_with(
        F.col(vector).cast("array<double>"), "_other", lambda a, b: a + F.col("share") * (b - a)
    )
    return (
        chosen.join(near, [key, "rank"])
        .join(other, "neighbour")
        .select(target, key, "neighbour", "share", between.alias(vector))
    )


def neighbour_vote(
    train: DataFrame, queries: DataFrame, key: str, vector: str, target: str, k: int = 5, positive: float = 1.0
) -> DataFrame:
    """``key, prediction, probability`` of each query by majority among its k nearest training rows.

    The smaller label wins a tie; ``probability`` is the share of neighbours with the positive label.
    """
    as_points = [F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector")]
    near = nearest(queries.select(as_points), train.select(as_points), k)
    labels = train.select(F.col(key).alias("neighbour"), F.col(target).cast("double").alias("label"))
    votes = near.join(labels, "neighbour").groupBy("id", "label").agg(F.count("*").alias("n"))
    return votes.groupBy(F.col("id").alias(key)).agg(
        F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("prediction"),
        (F.sum(F.when(F.col("label") == positive, F.col("n")).otherwise(0)) / F.sum("n")).alias("probability"),
    )
