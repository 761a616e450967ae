"""Benchmark decontamination: one Aho-Corasick automaton over normalised test items, one scan of every text.

Texts are lower-cased in A-Z and cut into words of digits, ASCII letters and non-ASCII characters. A window is ``width``
consecutive words of an item; an item of fewer words, but not none, is one window. The automaton holds every distinct
window as text with one blank around each word, so a match always begins and ends at a word. A text is scanned once in
the same form; a match is mapped to word numbers and from there to bytes of the original text.

Items are a test set, not corpus data: they are read in blocks of at most ``block_bytes`` of window text, each block is
one automaton (built once per worker) and one scan, and the hits of several blocks are joined by row. So neither the
driver nor a worker ever holds more than one block.

Defined results: null and empty texts have no words and no hits; null, empty or wordless items have no window; equal
items are all reported; an empty benchmark leaves every row clean. Repeated rows are each scanned; other columns of the
documents are ignored by ``contamination`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.kernels import LOWER, MARKS, Texts, pieces, texts_of, words

_NORMAL = bytes(0x20 if MARKS[b] else int(LOWER[b]) for b in range(256))
_automata: dict[str, tuple[ahocorasick.Automaton, list[list[str]]]] = {}


def windows_of(text: str | None, width: int) -> list[bytes]:
    """The windows of an item, each as its words with one blank before and after every word."""
    found = (text or "").encode().translate(_NORMAL).split()
    if not found:
        return []
    n = max(len(found) - width + 1, 1)
    return [b" " + b" ".join(found[i : i + width]) + b" " for i in range(n)]


def _automaton(key: str, held, width: int):
    """The automaton of a broadcast block and the items of each window; a worker keeps one block."""
    if key not in _automata:
        items = held.value
        owners: dict[str, list[str]] = {}
        for item, text in items:
            for window in dict.fromkeys(windows_of(text, width)):
                owners.setdefault(window.decode("latin-1"), []).append(item)
        machine = ahocorasick.Automaton()
        for number, window in enumerate(owners):
            machine.add_word(window, (number, len(window), window.count(" ") - 1))
        if owners:
            machine.make_automaton()
        _automata.clear()
        _automata[key] = machine, list(owners.values())
    return _automata[key]


def _scan(texts: Texts, machine, owners) -> Iterator[tuple[int, int, list[tuple[int, int, int, int, int]]]]:
    """Per text: its number, its words and its matches as (first word, words, first byte, end byte, window)."""
    for i in range(len(texts)):
        normal = texts.text(i).translate(_NORMAL)
        found = normal.split()
        matches = []
        if found and owners:
            line = " " + b" ".join(found).decode("latin-1") + " "
            hits = list(machine.iter(line))
            if hits:
                place = words(Texts(np.frombuffer(normal, np.uint8), np.array([0, len(normal)])), MARKS)
                blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 0x20)
                for end, (window, length, n) in hits:
                    first = int(np.searchsorted(blanks, end - length + 1))
                    matches.append((first, n, int(place.begin[first]), int(place.end[first + n - 1]), window))
        yield i, len(found), matches


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, width: int, block_bytes: int) -> Iterator[list]:
    """Items in blocks, read one block at a time; an item longer than a block is a block of its own."""
    block, size = [], 0
    items = benchmark.select(F.col(item_col).cast("string"), F.col(text_col).cast("string"))
    for item, text in items.toLocalIterator():
        weight = (width + 1) * len((text or "").encode())
        if block and size + weight > block_bytes:
            yield block
            block, size = [], 0
        block.append((item or "", text or ""))
        size += weight
    yield block


_SCHEMA = (
    "n_words long, n_hit long, n_items long, items array<string>, spans array<struct<first_word:long, last_word:long, "
    "begin:long, end:long>>"
)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """Per row: words, words inside any occurrence of a window, items met, and the merged spans in the original text.

    Spans give words by number and bytes of the original UTF-8 text.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    blocks = list(_numbered(spark, _blocks(benchmark, item_col, item_text_col, width, block_bytes)))

    def scanned(frame: DataFrame, held, schema: str, hits_only: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine, owners = _automaton(*held, width)
            for batch in batches:
                texts = texts_of(batch.column("text"))
                out = []
                for first, piece in pieces(texts):
                    for i, n, matches in _scan(piece, machine, owners):
                        if matches or not hits_only:
                            out.append((first + i, n, *_merged(matches, owners)))
                at = pa.array([o[0] for o in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [c.take(at) for k, c in enumerate(batch.columns) if batch.schema.names[k] != "text"]
                    + [
                        pa.array([o[1] for o in out], pa.int64()),
                        pa.array([o[2] for o in out], pa.int64()),
                        pa.array([len(o[3]) for o in out], pa.int64()),
                        pa.array([o[3] for o in out], pa.list_(pa.string())),
                        pa.array([o[4] for o in out], pa.list_(_SPAN)),
                    ],
                    names=[n for n in batch.schema.names if n != "text"] + _NAMES,
                )

        return frame.mapInArrow(run, schema)

    if len(blocks) == 1:
        return scanned(source, blocks[0], f"id {kind}, {_SCHEMA}", False).withColumnRenamed("id", id_col)
    # Several blocks: hits of each by row content, then one row per text with the union of spans and items.
    keyed = source.withColumn("h", F.xxhash64("text")).select("id", "h", "text")
    schema = f"id {kind}, h long, {_SCHEMA}"
    hits = None
    for held in blocks[1:]:
        more = scanned(keyed.dropDuplicates(["id", "h"]), held, schema, True).select("id", "h", "items", "spans")
        hits = more if hits is None else hits.unionByName(more)
    hits = hits.groupBy("id", "h").agg(F.collect_list("items").alias("more"), F.collect_list("spans").alias("other"))
    base = scanned(keyed, blocks[0], schema, False)
    both = base.alias("a").join(hits.alias("b"), F.expr("a.id <=> b.id AND a.h <=> b.h"), "left")
    merge = F.udf(_union, "struct<n_hit:long, items:array<string>, spans:array<struct<first_word:long, "
                          "last_word:long, begin:long, end:long>>>")
    whole = both.select("a.id", "a.n_words", merge("a.items", "a.spans", "b.more", "b.other").alias("m"))
    return whole.select(
        F.col("id").alias(id_col), "n_words", "m.n_hit", F.size("m.items").cast("long").alias("n_items"),
        "m.items", "m.spans",
    )


_SPAN = pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())])
_NAMES = ["n_words", "n_hit", "n_items", "items", "spans"]


def _numbered(spark, blocks):
    for block in blocks:
        yield uuid.uuid4().hex, spark.sparkContext.broadcast(block)


def _merged(matches, owners) -> tuple[int, list[str], list[dict]]:
    """Words hit, items met (sorted) and matches merged into spans that do not overlap."""
    spans: list[list[int]] = []
    for first, n, begin, end, _ in sorted(matches):
        if spans and first <= spans[-1][1] + 1:
            if first + n - 1 > spans[-1][1]:
                spans[-1][1], spans[-1][3] = first + n - 1, end
        else:
            spans.append([first, first + n - 1, begin, end])
    items = sorted({item for m in matches for item in owners[m[4]]})
    named = [dict(zip(("first_word", "last_word", "begin", "end"), s, strict=True)) for s in spans]
    return sum(s[1] - s[0] + 1 for s in spans), items, named


def _union(items, spans, more, other):
    everything = sorted(tuple(s) for part in [spans, *(other or [])] for s in part)
    merged: list[list[int]] = []
    for span in everything:
        if merged and span[0] <= merged[-1][1] + 1:
            if span[1] > merged[-1][1]:
                merged[-1][1], merged[-1][3] = span[1], span[3]
        else:
            merged.append(list(span))
    names = sorted({i for part in [items, *(more or [])] for i in part})
    return sum(s[1] - s[0] + 1 for s in merged), names, [tuple(s) for s in merged]


def items_digest(items: str = "items") -> F.Column:
    """Lower-case SHA-256 of the sorted item ids, joined by commas."""
    return F.sha2(F.concat_ws(",", items), 256)


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 32 << 20,
) -> DataFrame:
    """The documents without a hit, with all their columns; a filter without shuffle, one pass for each block."""
    spark, at = docs.sparkSession, docs.columns.index(text_col)

    def clean(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            machine, owners = _automaton(*held, width)
            for batch in batches:
                keep = [
                    not matches
                    for _, piece in pieces(texts_of(batch.column(at)))
                    for _, _, matches in _scan(piece, machine, owners)
                ]
                yield batch.filter(pa.array(keep, pa.bool_()))

        return run

    for held in _numbered(spark, _blocks(benchmark, item_col, item_text_col, width, block_bytes)):
        docs = docs.mapInArrow(clean(held), docs.schema)
    return docs
