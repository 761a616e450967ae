"""Removal of repeated passages: paragraph MinHash with banding, verified, clustered by components.

A paragraph is a line. Paragraphs of at least ``min_paragraph`` words get MinHash values of their 5-word shingles; the
number of bands and rows is tuned so that two paragraphs at the threshold meet with the wanted chance. Paragraphs that
collide in a band are joined, verified by the exact Jaccard similarity of their whole sets, and linked; a component of
links keeps its earliest paragraph (smallest id, then place) and marks the others. The links are found in two rounds, as
in ``jaccard_join``: each colliding paragraph against one pivot, then all pairs that lie in different components. Paragraphs
of half the threshold collide often; a shard compares the outlines of their sets, and only pairs that may reach the
threshold by this exact bound are joined with their sets.

A passage may also lie inside paragraphs that differ around it. Its sentences are paragraphs of their own then: equal
sentences (of at least ``min_sentence`` words) keep the earliest and mark the others.

Marked sentences that follow each other, shorter ones between them included, form a passage. A passage of at least
``min_words`` words is removed; a shorter one, such as a single common line, stays. Runs of ``min_run`` words or more that
an earlier place has are removed as well, wherever they begin and end (``repeated_windows``).

Only hashes travel: a sentence or paragraph that repeats within a batch is sent once, so a passage in a third of all
texts costs one row for each batch. Whole texts are read again for those that hold something to compare or to cut.

Defined results: null, empty and blank texts have nothing to remove; rows of one id are told apart by their texts, equal
ones count once and get equal results; a null id comes before all others. Ids must be whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.jaccard_join import (
    _PACKED,
    _places,
    _shared,
    _stars,
    agreed,
    outline,
    posted_rows,
    posted_schema,
    settled,
)
from larkspur.llm.kernels import (
    SMALL_PIECE,
    binary,
    joined,
    mix,
    packed,
    pieces,
    powers,
    range_hashes,
    shard_of,
    shingles,
    split_by,
    texts_of,
    unpacked,
    word_hashes,
    words,
)
from larkspur.llm.repeated_windows import merged, repeated_runs
from larkspur.workspace import materialize

_SHORT = np.uint32
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b".!?")] = True


def tune(threshold: float, recall: float, most: int = 64) -> tuple[int, int]:
    """Bands and rows with the fewest hash values for which a pair at the threshold collides with the wanted chance,
    with at least three rows, so that pairs far below it seldom do."""
    best = None
    for rows in range(3, 9):
        for bands in range(1, most):
            if 1 - (1 - threshold**rows) ** bands >= recall:
                if best is None or bands * rows < best[0] * best[1]:
                    best = bands, rows
                break
    if best is None:
        raise ValueError("no number of bands reaches this recall")
    return best


class Layout:
    """Words, sentences and paragraphs of a piece of texts; sentences and paragraphs by their first word."""

    def __init__(self, piece):
        self.piece = piece
        self.words = found = words(piece)
        self.hashes = word_hashes(piece, found)
        n = len(found)
        lines = np.concatenate([[0], np.cumsum(piece.data == 0x0A)])
        starts = np.zeros(n, bool)
        starts[found.first[:-1][found.counts > 0]] = True
        broken = np.ones(n, bool)
        broken[1:] = lines[found.begin[1:]] != lines[found.end[:-1]]
        ended = np.ones(n, bool)
        ended[1:] = _SIGNS[piece.data[found.end[:-1] - 1]] if n else ended[1:]
        self.paragraphs = np.concatenate([np.flatnonzero(starts | broken), [n]]).astype(np.int64)
        self.sentences = np.concatenate([np.flatnonzero(starts | broken | ended), [n]]).astype(np.int64)

    def owner(self, units: np.ndarray) -> np.ndarray:
        """Number of the text of each unit, and the unit's number in it."""
        text = np.searchsorted(self.words.first, units[:-1], "right") - 1
        return text, np.arange(len(text)) - np.searchsorted(text, text)

    def content(self, units: np.ndarray) -> np.ndarray:
        """Hash of the words of each unit."""
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self.hashes * powers(len(self.hashes)))])
        return range_hashes(sums, units[:-1], units[1:])


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(int(np.iinfo(np.int64).min)))
    return docs.select(key.alias("key"), F.xxhash64(text).alias("version"), text.alias("text"))


def _layouts(batch: pa.RecordBatch) -> Iterator[tuple[int, Layout]]:
    for first, piece in pieces(texts_of(batch.column("text")), SMALL_PIECE):
        yield first, Layout(piece)


def _sentences(shards: int, min_sentence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per batch and shard: each sentence once, at its earliest place, and all its other places."""
        for batch in batches:
            keys, versions = batch.column("key").to_numpy(), batch.column("version").to_numpy()
            parts = []
            for first, layout in _layouts(batch):
                size = np.diff(layout.sentences)
                text, number = layout.owner(layout.sentences)
                use = size >= min_sentence
                text = first + text[use]
                parts.append((layout.content(layout.sentences)[use], keys[text], versions[text], number[use]))
            if not parts:
                continue
            name, key, version, number = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((number, version, key, name))
            name, key, version, number = name[order], key[order], version[order], number[order].astype(np.uint32)
            lead = np.ones(len(name), bool)
            lead[1:] = name[1:] != name[:-1]
            sent = dict(split_by(shard_of(name[lead], shards), shards, *(c[lead] for c in (name, key, version, number))))
            other = dict(split_by(shard_of(name[~lead], shards), shards, *(c[~lead] for c in (key, version, number))))
            for k in sorted(sent):
                a, b = sent[k], other.get(k, [key[:0], version[:0], number[:0]])
                row = [packed(a[0], True), packed(a[1]), a[2].tobytes(), packed(a[3]), *(c.tobytes() for c in b)]
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(pa.array([c], pa.binary()) for c in row)],
                                                 names=_SENTENCE)

    return run


_SENTENCE = ["shard", "name", "key", "version", "number", "other_key", "other_version", "other_number"]


def _later_sentences(table: pa.Table) -> pa.Table:
    """All places of a shard's sentences but the earliest of each."""
    rows = table.select(_SENTENCE[1:5]).to_pylist()
    name = np.concatenate([unpacked(r["name"], np.uint64, True) for r in rows])
    key = np.concatenate([unpacked(r["key"], np.int64) for r in rows])
    version = np.concatenate([np.frombuffer(r["version"], np.int64) for r in rows])
    number = np.concatenate([unpacked(r["number"], np.uint32) for r in rows])
    order = np.lexsort((number, version, key, name))
    name, key, version, number = name[order], key[order], version[order], number[order]
    lead = np.maximum.accumulate(np.where(np.concatenate([[True], name[1:] != name[:-1]]), np.arange(len(name)), 0))
    # The same place, of an equal row of the same id, is no later one.
    later = (key != key[lead]) | (version != version[lead]) | (number != number[lead])
    others = [joined(table[c], t) for c, t in (("other_key", np.int64), ("other_version", np.int64), ("other_number", np.uint32))]
    return pa.table(
        {
            "key": np.concatenate([key[later], others[0]]),
            "version": np.concatenate([version[later], others[1]]),
            "number": np.concatenate([number[later], others[2]]).astype(np.int64),
        }
    )


def _paragraphs(min_paragraph: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each paragraph of some length: the hash of its words and its place."""
        for batch in batches:
            for first, layout in _layouts(batch):
                use = np.diff(layout.paragraphs) >= min_paragraph
                text, number = layout.owner(layout.paragraphs)
                at = pa.array(first + text[use])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(layout.content(layout.paragraphs)[use].view(np.int64)), batch.column("key").take(at),
                     batch.column("version").take(at), pa.array(number[use].astype(np.int64))],
                    names=["node", "key", "version", "number"],
                )

    return run


def _signatures(sets: np.ndarray, begin: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Band hashes of each set (one row a set): smallest values under ``bands * rows`` products, joined by ``rows``."""
    factors = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
    out = np.zeros((len(begin) - 1, bands), np.uint64)
    for k, factor in enumerate(factors):
        least = np.minimum.reduceat(mix(sets * factor), begin[:-1])
        out[:, k // rows] = mix(out[:, k // rows] + least + np.uint64(k))
    return out


def _different(sets: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Size of each set as ``_sets`` counts it: a shingle that repeats counts once."""
    owner = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    half = sets >> np.uint64(32)
    order = np.lexsort((half, owner))
    half, owner = half[order], owner[order]
    new = np.ones(len(half), bool)
    new[1:] = (half[1:] != half[:-1]) | (owner[1:] != owner[:-1])
    return np.bincount(owner[new], minlength=len(begin) - 1)


def _bands(shards: int, bands: int, rows: int, width: int, min_paragraph: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Band hashes of the different paragraphs of a batch, posted by shard."""
        for batch in batches:
            parts = []
            for _, layout in _layouts(batch):
                content = layout.content(layout.paragraphs)
                use = np.flatnonzero(np.diff(layout.paragraphs) >= min_paragraph)
                _, first_of, times = np.unique(content[use], return_index=True, return_counts=True)
                use = use[first_of]
                if not len(use):
                    continue
                sets, begin = shingles(*_selected(layout, use), width)
                parts.append((content[use], _different(sets, begin), times, _signatures(sets, begin, bands, rows)))
            if not parts:
                continue
            node, size, times, signs = (np.concatenate(c) for c in zip(*parts, strict=True))
            node, at, again = np.unique(node, return_index=True, return_inverse=True)
            # A paragraph weighs as often as it occurs: copies come from what occurs most.
            times = np.bincount(again, times).astype(np.int64)
            size, signs = size[at], signs[at]
            owner = np.repeat(np.arange(len(node)), bands)
            gram = signs.reshape(-1)
            yield from posted_rows(gram, owner, np.zeros(len(gram), np.uint32), node.view(np.int64),
                                   size.astype(np.int32), times, np.zeros(0, np.int64), np.zeros(0, np.int64), shards)

    return run


def _selected(layout: Layout, use: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of some paragraphs, end to end, and where each begins."""
    begin, size = layout.paragraphs[use], np.diff(layout.paragraphs)[use]
    first = np.concatenate([[0], np.cumsum(size)])
    return layout.hashes[np.repeat(begin - first[:-1], size) + np.arange(first[-1])], first


def _sets(source: DataFrame, places: DataFrame, nodes: DataFrame, width: int, min_paragraph: int) -> DataFrame:
    """Distinct shingle hashes of these paragraphs, from one text that holds each, and their outlines."""
    home = places.join(nodes, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
    wanted = materialize(home.groupBy("key").agg(F.collect_set("node").alias("nodes")), "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column("nodes").offsets)
            nodes = batch.column("nodes").values.to_numpy().view(np.uint64)
            for first, layout in _layouts(batch):
                content = layout.content(layout.paragraphs)
                text, _ = layout.owner(layout.paragraphs)
                long_ones = np.diff(layout.paragraphs) >= min_paragraph
                use = [
                    k for k in np.flatnonzero(long_ones)
                    if content[k] in nodes[at[first + text[k]] : at[first + text[k] + 1]]
                ]
                if use:
                    sets, begin = shingles(*_selected(layout, np.array(use)), width)
                    # Half of a hash tells the shingles of two paragraphs apart, and halves what the joins carry.
                    found = [
                        np.unique((sets[a:b] >> np.uint64(32)).astype(_SHORT))
                        for a, b in zip(begin[:-1], begin[1:], strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(content[use].view(np.int64)), pa.array([len(s) for s in found], pa.int64()), binary(found),
                         binary([outline(s) for s in found])],
                        names=["node", "n", "grams", "outline"],
                    )

    few = wanted.where(F.size("nodes") > 0)
    texts = source.join(few, "key").select("key", "version", "text", "nodes")
    return materialize(texts.mapInArrow(run, "node long, n long, grams binary, outline binary").dropDuplicates(["node"]), "sets")


def _near_paragraphs(
    source: DataFrame, threshold: int, recall: float, width: int, min_paragraph: int, shards: int
) -> DataFrame:
    """Places of paragraphs that are near copies of an earlier one: key, version and number of the paragraph."""
    bands, rows = tune(threshold / 100, recall)
    places = materialize(
        source.mapInArrow(_paragraphs(min_paragraph), "node long, key long, version long, number long"), "paragraphs"
    )
    sent = source.mapInArrow(_bands(shards, bands, rows, width, min_paragraph), posted_schema())
    posted = materialize(sent.groupBy("shard").applyInArrow(_shared, _PACKED), "posted")
    here = materialize(posted.mapInArrow(_places, "shard int, owner long").distinct(), "places")
    members = materialize(here.select("owner", F.col("owner").alias("node")).distinct(), "members")
    # The sets of all paragraphs that collide, taken from the texts once.
    sets = _sets(source, places, members.select("node"), width, min_paragraph)
    stars = materialize(posted.mapInArrow(_stars(threshold), "a long, b long").distinct(), "stars")
    near = materialize(agreed(stars, sets, threshold, _SHORT), "near")
    found = settled(near, posted, here, members, sets, threshold, _SHORT, sets.select("node", "outline"))
    held = materialize(places.join(found, "node").drop("node"), "held")
    first = held.groupBy("component").agg(F.min(F.struct("key", "version", "number")).alias("first"))
    later = held.join(first, "component").where(F.struct("key", "version", "number") != F.col("first"))
    return later.select("key", "version", "number")


def _cut(min_sentence: int, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The texts that lose a passage, without it."""
        for batch in batches:
            versions = batch.column("version").to_pylist()
            marks = batch.column("marks").to_pylist()
            at, out = [], []
            for first, layout in _layouts(batch):
                sentence_text, number = layout.owner(layout.sentences)
                size = np.diff(layout.sentences)
                line = np.searchsorted(layout.paragraphs, layout.sentences[:-1], "right") - 1
                line_text, _ = layout.owner(layout.paragraphs)
                edge = np.searchsorted(sentence_text, np.arange(len(layout.piece) + 1))
                line_edge = np.searchsorted(line_text, np.arange(len(layout.piece) + 1))
                for i in range(len(layout.piece)):
                    mine = [m for m in marks[first + i] if m["version"] == versions[first + i]]
                    runs = [(m["number"], m["end"]) for m in mine if m["end"] is not None]
                    mine = [m for m in mine if m["end"] is None]
                    n = edge[i + 1] - edge[i]
                    if not (mine or runs) or not n:
                        continue
                    marked = np.zeros(n, bool)
                    marked[[m["number"] for m in mine if m["sentence"]]] = True
                    lines = np.zeros(line_edge[i + 1] - line_edge[i], bool)
                    lines[[m["number"] for m in mine if not m["sentence"]]] = True
                    marked |= lines[line[edge[i] : edge[i + 1]] - line_edge[i]]
                    spans = _passages(marked, size[edge[i] : edge[i + 1]], min_sentence, min_words)
                    word = layout.sentences[edge[i] : edge[i + 1] + 1] - layout.words.first[i]
                    spans = np.array([(word[a], word[b]) for a, b in spans] + runs, np.int64).reshape(-1, 2)
                    if len(spans):
                        same = np.zeros(len(spans), np.int64)
                        _, _, begin, end = merged(same, same, spans[:, 0], spans[:, 1])
                        at.append(first + i)
                        out.append(_without(layout, i, begin, end))
            where = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(where), batch.column("version").take(where),
                 pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                 pa.array([o[2] for o in out], pa.string())],
                names=["key", "version", "n_removed", "n_passages", "kept"],
            )

    return run


def _passages(marked: np.ndarray, size: np.ndarray, min_sentence: int, min_words: int) -> list[tuple[int, int]]:
    """Runs of marked sentences, short ones between two marked ones included, of ``min_words`` words or more."""
    out, start, end, n = [], None, None, 0
    for k in range(len(marked) + 1):
        if k < len(marked) and marked[k]:
            start = k if start is None else start
            end = k
        elif start is not None and (k == len(marked) or size[k] >= min_sentence):
            n = int(size[start : end + 1].sum())
            if n >= min_words:
                out.append((start, end + 1))
            start = None
    return out


def _without(layout: Layout, i: int, begin: np.ndarray, end: np.ndarray) -> tuple[int, int, str]:
    """Words removed, passages, and the text without the words of these ranges; blanks after a passage go with it."""
    text, origin = layout.piece.text(i), layout.piece.starts[i]
    kept, at, removed = [], 0, 0
    for a, b in zip(layout.words.first[i] + begin, layout.words.first[i] + end, strict=True):
        kept.append(text[at : layout.words.begin[a] - origin])
        last = layout.words.first[i + 1]
        at = layout.words.begin[b] - origin if b < last else len(text)
        removed += int(b - a)
    kept.append(text[at:])
    return removed, len(begin), b"".join(kept).decode()


def passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = 75,
    width: int = 5,
    recall: float = 0.999,
    min_paragraph: int = 20,
    min_sentence: int = 5,
    min_words: int = 30,
    min_run: int = 50,
) -> DataFrame:
    """The texts that lose something: key (the id), version (hash of the text), n_removed words, n_passages, kept."""
    # Several shards for each task of a shuffle: a group is what a task holds at once.
    shards = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    source = _source(docs, id_col, text_col)
    sent = source.mapInArrow(
        _sentences(shards, min_sentence), ", ".join(f"{c} {'int' if c == 'shard' else 'binary'}" for c in _SENTENCE)
    )
    later = sent.groupBy("shard").applyInArrow(_later_sentences, "key long, version long, number long")
    near = _near_paragraphs(source, threshold, recall, width, min_paragraph, shards)
    runs = repeated_runs(source, min_run, shards)
    none = F.lit(None).cast("long")
    marks = later.select("*", none.alias("end"), F.lit(True).alias("sentence"))
    marks = marks.union(near.select("*", none.alias("end"), F.lit(False).alias("sentence")))
    marks = marks.union(runs.select("key", "version", "begin", "end", F.lit(False).alias("sentence")))
    marks = marks.groupBy("key").agg(F.collect_set(F.struct("version", "number", "end", "sentence")).alias("marks"))
    marks = materialize(marks, "marks").where(F.size("marks") > 0)
    whole = source.join(marks, "key").select("key", "version", "text", "marks")
    schema = "key long, version long, n_removed long, n_passages long, kept string"
    return whole.mapInArrow(_cut(min_sentence, min_words), schema).dropDuplicates(["key", "version"])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> tuple[F.Column, F.Column]:
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(int(np.iinfo(np.int64).min)))
    return key, F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def passage_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """Per row: n_removed words, n_passages and the SHA-256 of the text that is kept."""
    key, version = _keyed(docs, id_col, text_col)
    whole = docs.select(
        F.col(id_col), key.alias("key"), version.alias("version"),
        F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256).alias("whole"),
    )
    cut = passages(docs, id_col, text_col, **settings)
    cut = cut.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")
    return whole.join(cut, ["key", "version"], "left").select(
        id_col,
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_passages", F.lit(0)).alias("n_passages"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"),
    )


def remove_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents with all their columns, texts cut; a row whose text is nothing but removed passages stays, empty."""
    key, version = _keyed(docs, id_col, text_col)
    cut = passages(docs, id_col, text_col, **settings).select(
        F.col("key").alias("_cut_key"), F.col("version").alias("_cut_version"), F.col("kept").alias("_cut_text")
    )
    whole = docs.join(cut, (key == F.col("_cut_key")) & (version == F.col("_cut_version")), "left")
    texts = {text_col: F.coalesce("_cut_text", F.col(text_col))}
    return whole.withColumns(texts).drop("_cut_key", "_cut_version", "_cut_text")
