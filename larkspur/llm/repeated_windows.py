"""Runs of words that an earlier place has too, wherever they begin and end.

A window is ``length`` words that follow each other in one text, across lines and without regard to punctuation. A window
goes if an equal one stands earlier: in a smaller (key, version), or before it in the same text without overlapping it.
The runs are those of all windows that go, so a run is as long as what its text shares.

Equal windows have the same smallest hash of ``length // 5`` words, their anchor. A run of windows with one anchor is a
segment. First only anchors travel; then the window hashes of segments whose anchor occurs again are dealt by the anchor,
so a shard holds all windows that may be equal. Segments that repeat whole within a batch send their place alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.kernels import (
    SMALL_PIECE,
    joined,
    packed,
    pieces,
    powers,
    range_hashes,
    shard_of,
    split_by,
    texts_of,
    unpacked,
    word_hashes,
    words,
)
from larkspur.workspace import materialize

_PLACE = {"key": np.int64, "version": np.int64, "start": np.int64, "n": np.int64}
_OTHER = {f"other_{c}": t for c, t in _PLACE.items()}
SPAN = "key long, version long, begin long, end long"


def _segments(piece, length: int):
    """Per segment: its text, first word in the text, windows and anchor, and where its windows begin; all window hashes."""
    found = words(piece)
    hashes = word_hashes(piece, found)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(hashes * powers(len(hashes)))])
    counts = np.maximum(found.counts - length + 1, 0)
    first = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(piece)), counts)
    start = np.arange(len(text)) - first[text]
    at = found.first[:-1][text] + start
    width = max(1, length // 5)
    low = range_hashes(sums, np.arange(max(len(found) - width + 1, 0)), np.arange(width, len(found) + 1))
    # The smallest of so many neighbours, by doubling.
    span, have = length - width + 1, 1
    while have < span:
        step = min(have, span - have)
        low = np.minimum(low[: max(len(low) - step, 0)], low[step:])
        have += step
    anchor = low[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(new)
    n = np.diff(np.concatenate([begin, [len(at)]]))
    return text[begin], start[begin], n, anchor[begin], begin, range_hashes(sums, at, at + length)


def _anchors(shards: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Anchors of every text, posted by shard; one that may repeat within its own segment, twice."""
        for batch in batches:
            keys, parts = batch.column("key").to_numpy(), []
            for first, piece in pieces(texts_of(batch.column("text")), SMALL_PIECE):
                text, _, n, anchor, _, _ = _segments(piece, length)
                again = np.where(n > length, 2, 1)
                parts.append((np.repeat(anchor, again), np.repeat(keys[first + text], again)))
            if not parts:
                continue
            anchor, key = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((key, anchor))
            anchor, key = anchor[order], key[order]
            for k, (a, b) in split_by(shard_of(anchor, shards), shards, anchor, key):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), pa.array([packed(a, True)]), pa.array([packed(b)])],
                    names=["shard", "anchor", "key"],
                )

    return run


def _again(table: pa.Table) -> pa.Table:
    """Anchors of a shard that occur twice or more, with the keys that have them."""
    rows = table.to_pylist()
    anchor = np.concatenate([unpacked(r["anchor"], np.uint64, True) for r in rows])
    key = np.concatenate([unpacked(r["key"], np.int64) for r in rows])
    order = np.lexsort((key, anchor))
    anchor, key = anchor[order], key[order]
    same = anchor[1:] == anchor[:-1]
    use = np.zeros(len(anchor), bool)
    use[1:] |= same
    use[:-1] |= same
    use[1:] &= ~(same & (key[1:] == key[:-1])) | ~use[1:]
    return pa.table({"key": key[use], "anchor": anchor[use].view(np.int64)})


def _windows(shards: int, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments with a wanted anchor, by its shard: places and window hashes; places of those that repeat whole."""
        for batch in batches:
            keys, versions = batch.column("key").to_numpy(), batch.column("version").to_numpy()
            edges = np.asarray(batch.column("anchors").offsets)
            wanted = batch.column("anchors").values.to_numpy().view(np.uint64)
            parts, held = [], []
            for first, piece in pieces(texts_of(batch.column("text")), SMALL_PIECE):
                text, start, n, anchor, begin, hashes = _segments(piece, length)
                some = np.unique(wanted[edges[first] : edges[first + len(piece)]])
                at = np.flatnonzero(np.isin(anchor, some))
                if not len(at):
                    continue
                n, begin = n[at], begin[at]
                here = np.cumsum(n) - n
                mine = hashes[np.repeat(begin - here, n) + np.arange(n.sum())]
                whole = np.add.reduceat(mine * powers(len(mine))[np.arange(len(mine)) - np.repeat(here, n)], here)
                held.append(mine)
                parts.append((whole, keys[first + text[at]], versions[first + text[at]], start[at], n, anchor[at]))
            if not parts:
                continue
            whole, key, version, start, n, anchor = (np.concatenate(c) for c in zip(*parts, strict=True))
            hashes = np.concatenate(held)
            begin = np.cumsum(n) - n
            order = np.lexsort((start, version, key, n, whole, anchor))
            whole, key, version, start, n, anchor, begin = (
                c[order] for c in (whole, key, version, start, n, anchor, begin)
            )
            new = np.ones(len(order), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]) | (n[1:] != n[:-1])
            lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            own = (key == key[lead]) & (version == version[lead])
            # Of equal rows one is enough; a segment that overlaps its equal is judged window by window.
            other = ~own | (start >= start[lead] + length)
            sent = np.flatnonzero(~other & (new | (start != start[lead])))
            other = np.flatnonzero(other)
            places = dict(split_by(shard_of(anchor[other], shards), shards, other))
            for k, (mine,) in split_by(shard_of(anchor[sent], shards), shards, sent):
                columns = [key[mine], version[mine], start[mine], n[mine]]
                size = n[mine]
                at = np.repeat(begin[mine] - (np.cumsum(size) - size), size) + np.arange(size.sum())
                rest = places.get(k, [other[:0]])[0]
                columns += [hashes[at], key[rest], version[rest], start[rest], n[rest]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                    names=["shard", *_PLACE, "window", *_OTHER],
                )

    return run


def _later(length: int):
    def run(table: pa.Table) -> pa.Table:
        """Runs of the windows of a shard that an earlier place has."""
        key, version, start, n = (joined(table[c], t) for c, t in _PLACE.items())
        window = joined(table["window"], np.uint64)
        owner = np.repeat(np.arange(len(n)), n)
        word = start[owner] + np.arange(len(window)) - (np.cumsum(n) - n)[owner]
        # Segments by place first, then windows by a stable sort: equal windows lie by place.
        rank = np.empty(len(n), np.int64)
        rank[np.lexsort((start, version, key))] = np.arange(len(n))
        order = np.lexsort((word, rank[owner], window))
        owner, word, window = owner[order], word[order], window[order]
        new = np.ones(len(order), bool)
        new[1:] = window[1:] != window[:-1]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        own = (key[owner] == key[owner[lead]]) & (version[owner] == version[owner[lead]])
        hit = ~own | (word >= word[lead] + length)
        owner, word = owner[hit], word[hit]
        rest = [joined(table[c], t) for c, t in _OTHER.items()]
        keys, versions = np.concatenate([key[owner], rest[0]]), np.concatenate([version[owner], rest[1]])
        begin = np.concatenate([word, rest[2]])
        end = np.concatenate([word + length, rest[2] + rest[3] - 1 + length])
        return pa.table(dict(zip(("key", "version", "begin", "end"), merged(keys, versions, begin, end), strict=True)))

    return run


def merged(key: np.ndarray, version: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranges of each text that overlap or touch, made one."""
    order = np.lexsort((end, begin, version, key))
    key, version, begin, end = key[order], version[order], begin[order], end[order]
    if not len(order):
        return [key, version, begin, end]
    text = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]) | (version[1:] != version[:-1]))])
    # Ends that only rise, each text above the one before it.
    step = int(end.max()) + 1
    top = np.maximum.accumulate(text * step + end)
    new = np.ones(len(order), bool)
    new[1:] = text[1:] * step + begin[1:] > top[:-1]
    at = np.flatnonzero(new)
    last = np.concatenate([at[1:], [len(order)]]) - 1
    return [key[at], version[at], begin[at], top[last] - text[at] * step]


def repeated_runs(source: DataFrame, length: int, shards: int) -> DataFrame:
    """Runs of words of ``source`` (key, version, text) that an earlier place has: key, version, begin and end, by word."""
    posted = source.mapInArrow(_anchors(shards, length), "shard int, anchor binary, key binary")
    again = posted.groupBy("shard").applyInArrow(_again, "key long, anchor long")
    wanted = materialize(again.groupBy("key").agg(F.collect_set("anchor").alias("anchors")), "anchors")
    texts = source.join(wanted, "key").select("key", "version", "text", "anchors")
    columns = ", ".join(f"{c} binary" for c in (*_PLACE, "window", *_OTHER))
    sent = texts.mapInArrow(_windows(shards, length), f"shard int, {columns}")
    return sent.groupBy("shard").applyInArrow(_later(length), SPAN)
