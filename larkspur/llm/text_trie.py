"""Equal texts found by compressed tries over ranges of texts.

The upper part of the trie is counted, not built. A level takes the first 8, 32, 128, ... bytes of each text; a prefix
that stands for more bytes of text than a task should hold goes on to the next level, all others become the *adaptive
prefix* of their texts. A text that ends within a heavy prefix is a terminal of the upper part: its copies are combined on the
map side of that count, so a text that is a third of all rows is a few rows. There are fewer heavy prefixes than total
weight divided by the limit, which is what bounds the tables that are broadcast.

The rest is range-partitioned by adaptive prefixes and sorted; a task inserts whole texts into a compressed trie, keeps the
least id at each terminal, and starts a new trie at a change of prefix once it holds enough.

Defined results: null texts count as empty. A row without an id is no earlier copy of anything and has none. Rows of one id
are no copies of each other. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.kernels import texts_of

#: Bytes of the first level's prefixes; each further level takes four times as many.
FIRST = 8
#: Weight of a row besides its text.
ROW = 64
#: An adaptive prefix stands for at most this many bytes, or a quarter of an even share of the shuffle partitions.
LEAST_LIMIT = 256 << 10
#: Bytes of text after which a task starts a new trie.
TRIE = 16 << 20


class Node:
    """Where texts part, or end; ``least`` is the smallest id of the texts that end here."""

    __slots__ = ("edges", "least")

    def __init__(self):
        self.edges: dict[int, tuple[bytes, Node]] = {}
        self.least = None


def shared(a: bytes, b: bytes, at: int) -> int:
    """Length of the common prefix of ``a`` and ``b[at:]``."""
    low, high = 0, min(len(a), len(b) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def insert(root: Node, text: bytes, id) -> Node:
    """Insert a whole text; returns its terminal, which stays the same when edges are split later."""
    node, at = root, 0
    while at < len(text):
        edge = node.edges.get(text[at])
        if edge is None:
            leaf = Node()
            node.edges[text[at]] = (text[at:], leaf)
            node, at = leaf, len(text)
        elif text.startswith(edge[0], at):
            node, at = edge[1], at + len(edge[0])
        else:
            label, below = edge
            n, fork = shared(label, text, at), Node()
            fork.edges[label[n]] = (label[n:], below)
            node.edges[text[at]] = (label[:n], fork)
            node, at = fork, at + n
    if id is not None and (node.least is None or id < node.least):
        node.least = id
    return node


def _prefix(width: int) -> Column:
    return F.substring(F.col("_text").cast("binary"), 1, width)


def _key(width: int) -> Column:
    """Names a prefix, and whether the text ends within it."""
    return F.concat(F.unhex(F.sha2(_prefix(width), 256)), F.when(_ended(width), F.lit(b"$")).otherwise(F.lit(b"")))


def _ended(width: int) -> Column:
    return F.octet_length("_text") <= width


def _levels(rows: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """The heavy prefixes of each level that has some, with the least id of texts that end there."""
    found, width, left = [], FIRST, rows
    while True:
        counted = left.groupBy(_key(width).alias("_key"), _ended(width).alias("_end")).agg(
            F.sum("_weight").alias("_sum"), F.min("_id").alias("_least")
        )
        # Fewer than total weight / limit rows.
        heavy = counted.where(F.col("_sum") > limit).select("_key", "_end", "_least").collect()
        if not heavy:
            return found
        table = rows.sparkSession.createDataFrame(heavy, counted.select("_key", "_end", "_least").schema)
        found.append((width, table))
        on = [_key(width) == table["_key"]]
        left = left.join(F.broadcast(table.where(~F.col("_end"))), on, "left_semi")
        width *= 4


def _tries(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Flags of rows sorted by adaptive prefix; columns are the prefix, the text, the id, and what is handed on."""
    root, held, size, last = Node(), [], 0, None

    def flags() -> Iterator[pa.RecordBatch]:
        for batch, first, terminals in held:
            ids = batch.column(2).slice(first, len(terminals)).to_pylist()
            later = [n is not None and t.least is not None and t.least < n for n, t in zip(ids, terminals, strict=True)]
            own = [c.slice(first, len(terminals)) for c in batch.columns[3:]]
            yield pa.RecordBatch.from_arrays([*own, pa.array(later, pa.bool_())], names=names)

    for batch in batches:
        groups, texts, ids = batch.column(0).to_pylist(), texts_of(batch.column(1)), batch.column(2).to_pylist()
        # Handed-on columns and ids are kept until the trie is done; the texts themselves only in the trie.
        batch = pa.RecordBatch.from_arrays([batch.column(0), pa.nulls(batch.num_rows), *batch.columns[2:]], batch.schema.names)
        held.append((batch, 0, []))
        for i, (group, id) in enumerate(zip(groups, ids, strict=True)):
            if size > TRIE and group != last:
                yield from flags()
                root, held, size = Node(), [(batch, i, [])], 0
            text = texts.text(i)
            held[-1][2].append(insert(root, text, id))
            size += len(text) + ROW
            last = group
    yield from flags()


def mark_copies(
    docs: DataFrame, id_col: str, text_col: str, handed: Mapping[str, Column], name: str = "copy"
) -> DataFrame:
    """For each row of ``docs`` the columns ``handed``, and whether a smaller id has the same whole text.

    ``handed`` are expressions over ``_id``, ``_text`` (null is empty) and ``row`` (a struct of all other columns). They are
    evaluated after the texts are dealt, so their work is done once.
    """
    spark = docs.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(
        docs[id_col].alias("_id"),
        F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"),
        F.struct(*[docs[c] for c in docs.columns if c != text_col]).alias("row"),
    ).withColumn("_weight", (F.octet_length("_text") + ROW).cast("long"))
    total = rows.agg(F.sum("_weight")).first()[0] or 0
    levels = _levels(rows.select("_id", "_text", "_weight"), max(LEAST_LIMIT, total // (4 * shares)))

    dealt = rows.drop("_weight").withColumns(
        {"_group": F.lit(None).cast("binary"), "_least": F.lit(None).cast(rows.schema["_id"].dataType), "_top": F.lit(False)}
    )
    for width, table in levels:
        # A row that has its prefix, or ended above, takes no part in further levels.
        heavy = F.broadcast(table.select(F.col("_key").alias("_k"), F.col("_end").alias("_e"), F.col("_least").alias("_l")))
        open_ = F.col("_group").isNull() & ~F.col("_top")
        dealt = (
            dealt.withColumn("_key", F.when(open_, _key(width)))
            .join(heavy, F.col("_key") == F.col("_k"), "left")
            .withColumns({
                "_group": F.when(open_ & F.col("_k").isNull(), F.col("_key")).otherwise(F.col("_group")),
                "_least": F.when(F.col("_e"), F.col("_l")).otherwise(F.col("_least")),
                "_top": F.col("_top") | F.coalesce("_e", F.lit(False)),
            })
            .drop("_key", "_k", "_e", "_l")
        )
    last = levels[-1][0] * 4 if levels else FIRST
    dealt = dealt.withColumn("_group", F.when(~F.col("_top"), F.coalesce("_group", _key(last))))

    below = dealt.where(~F.col("_top")) if levels else dealt
    below = below.select("_id", "_text", "row", "_group", _prefix(16).alias("_at"))
    below = below.repartitionByRange(shares, "_at", "_group").sortWithinPartitions("_at", "_group")
    below = below.withColumn("_group", F.concat("_at", F.lit(b"|"), "_group"))
    columns = [c.alias(n) for n, c in handed.items()]
    ordered = below.select("_group", "_text", "_id", *columns)
    types = ", ".join(f"`{n}` {ordered.schema[n].dataType.simpleString()}" for n in handed)
    names = [*handed, name]
    flagged = ordered.mapInArrow(lambda batches: _tries(batches, names), f"{types}, `{name}` boolean")
    if not levels:
        return flagged
    copy = F.coalesce(F.col("_least") < F.col("_id"), F.lit(False))
    return flagged.unionByName(dealt.where("_top").select(*columns, copy.alias(name)))
