"""Suffix-array deduplication of byte strings over a whole corpus, in shards.

Every byte covered by a string of ``length`` bytes that also starts earlier (smaller id, or earlier in the same text) is
removed. Equal strings must meet in one shard without the corpus being in one place:

1. A string's anchor is the smallest hash of the 32-byte windows inside it, so equal strings have equal anchors.
   Neighbouring strings share anchors; a run of strings with one anchor is kept as one segment of text.
2. Anchors are dealt by hash, and those that occur once are dropped with their segments: their strings are unique. An
   anchor that repeats within a batch is sent once for the batch.
3. The segments of repeated anchors are dealt by anchor. Equal segments are collapsed to the earliest, first within a
   batch, then in the shard, so a passage that a third of all texts hold arrives once for each batch. Its other
   copies are covered by it.
4. A shard joins its different segments (but those alone with an anchor) to one string, classifies suffixes, sorts the leftmost-smaller substrings, and
   induces the suffix array (``suffix_array``). Neighbours in it whose common prefix reaches ``length`` bytes, taken from
   the bytes themselves, form a group of equal strings; all but the earliest are marked.
5. Marked runs return to their texts by id, and the texts are cut.

Strings are judged on the input, so cutting has no order. Strings never cross texts and are bytes of UTF-8, so a cut may
fall inside a character; ``kept`` is binary.

Defined results: null and empty texts have no bytes; rows of one id count as one text, so equal rows of one id don't
remove each other and get equal results; a null id comes before all others; other columns are ignored. Ids must be
whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.kernels import (
    PIECE,
    Texts,
    binary,
    joined,
    mix,
    pieces,
    powers,
    prefix_hashes,
    range_hashes,
    shard_of,
    split_by,
    texts_of,
)
from larkspur.llm.suffix_array import common_prefixes_reach, suffix_order
from larkspur.workspace import materialize

#: Bytes of the windows an anchor is chosen from.
SEED = 32
#: Segment bytes of one suffix array; a shard with more is cut between anchors.
ARRAY = 1 << 20


def _chunks(texts: Texts, length: int) -> Iterator[tuple[int, int, Texts]]:
    """Pieces of whole texts; a text longer than a piece comes in parts that share ``length - 1`` bytes.

    With the number of the first text and the byte at which the part begins in it.
    """
    for first, piece in pieces(texts):
        if len(piece) > 1 or len(piece.data) <= 2 * PIECE:
            yield first, 0, piece
            continue
        for at in range(0, len(piece.data) - length + 1, PIECE):
            part = piece.data[at : at + PIECE + length - 1]
            yield first, at, Texts(part, np.array([0, len(part)]))


def _sliding(values: np.ndarray, span: int, smaller) -> np.ndarray:
    """The smallest (or largest) of every ``span`` neighbours, from those of 1, 2, 4, ..."""
    have = 1
    while 2 * have <= span:
        values = smaller(values[:-have], values[have:])
        have *= 2
    return smaller(values[: len(values) - (span - have)], values[span - have :]) if span > have else values


def segments_of(texts: Texts, length: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor: anchor, text, first byte (in ``texts.data``), number of strings, and whether the
    anchor's window occurs again inside the segment (which a text that repeats itself at once has)."""
    none = np.zeros(0, np.int64)
    n = len(texts.data)
    if n < length:
        return none.astype(np.uint64), none, none, none, none.astype(bool)
    sums = prefix_hashes(texts.data)
    seeds = mix((sums[SEED:] - sums[:-SEED]) * powers(n + 1, True)[: n + 1 - SEED])
    span = length - SEED + 1
    low = _sliding(seeds, span, np.minimum)
    room = np.repeat(texts.starts[1:], np.diff(texts.starts))[: len(low)]
    valid = np.arange(len(low)) + length <= room
    begin = valid.copy()
    begin[1:] &= ~valid[:-1] | (low[1:] != low[:-1])
    stop = valid.copy()
    stop[:-1] &= ~valid[1:] | (low[1:] != low[:-1])
    begin, stop = np.flatnonzero(begin), np.flatnonzero(stop)
    # A seed is the smallest of some string around it if it equals the largest of their smallest ones.
    around = np.concatenate([np.zeros(span - 1, np.uint64), low, np.zeros(span - 1, np.uint64)])
    chosen = np.flatnonzero(_sliding(around, span, np.maximum) == seeds)
    twice = chosen[1:][seeds[chosen[1:]] == seeds[chosen[:-1]]]
    # The segment's seeds are those of its first to its last string.
    last = np.searchsorted(twice, stop + span - 1, "right")
    return (low[begin], np.searchsorted(texts.starts, begin, "right") - 1, begin, stop - begin + 1,
            last > np.searchsorted(twice, begin))


def _brief(anchors: np.ndarray) -> np.ndarray:
    """32 bits of an anchor beside its shard; two anchors of one name only cost a look at the texts."""
    return (anchors & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def _anchors(length: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per batch and shard: each anchor once, with an id that has it and whether it repeats; and all other holders
        of those that repeat."""
        for batch in batches:
            ids, texts, found = _ids(batch.column(0)), texts_of(batch.column(1)), []
            for first, _, piece in _chunks(texts, length):
                anchors, text, _, _, again = segments_of(piece, length)
                found.append((anchors, ids[first + text], again))
            if not found:
                continue
            anchors, holder, inner = (np.concatenate(c) for c in zip(*found, strict=True))
            order = np.lexsort((~inner, holder, anchors))
            anchors, holder, inner = anchors[order], holder[order], inner[order]
            once = np.ones(len(anchors), bool)
            once[1:] = anchors[1:] != anchors[:-1]
            again = inner.copy()
            again[:-1] |= ~once[1:]
            other = ~once & np.concatenate([[True], (holder[1:] != holder[:-1]) | (anchors[1:] != anchors[:-1])])
            sent = once | other
            role = np.where(once, again.astype(np.uint8), np.uint8(2))
            anchors, holder, role = anchors[sent], holder[sent], role[sent]
            order = np.argsort(holder, kind="stable")  # equal ids stand together and compress
            anchors, holder, role = anchors[order], holder[order], role[order]
            dealt = list(split_by(shard_of(anchors, shards), shards, _brief(anchors), holder, role))
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in dealt], pa.int32()), *(binary([c[j] for _, c in dealt]) for j in range(3))],
                names=["shard", "anchor", "holder", "role"],
            )

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """The holders of a shard's anchors that occur more than once."""
    anchor, holder, role = (joined(table[n], t) for n, t in (("anchor", np.uint32), ("holder", np.int64), ("role", np.uint8)))
    order = np.argsort(anchor, kind="stable")
    anchor, holder, role = anchor[order], holder[order], role[order]
    keep = role > 0
    keep[1:] |= anchor[1:] == anchor[:-1]
    keep[:-1] |= anchor[1:] == anchor[:-1]
    return pa.table({"key": holder[keep], "anchor": anchor[keep].astype(np.int64)})


_SEGMENT = {"id": np.int64, "version": np.int64, "start": np.int64, "n": np.int32, "anchor": np.uint64, "inner": np.uint8}


def _gather(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The byte ranges of ``data``, end to end."""
    offset = np.concatenate([[0], np.cumsum(size)])
    return data[np.repeat(begin - offset[:-1], size) + np.arange(offset[-1])]


def _hashes(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each byte range, a megabyte of ranges at a time."""
    out, filled, first = np.empty(len(begin), np.uint64), np.cumsum(size), 0
    while first < len(begin):
        last = max(int(np.searchsorted(filled, filled[first] - size[first] + PIECE, "right")), first + 1)
        n = size[first:last]
        at = np.cumsum(n) - n
        out[first:last] = range_hashes(prefix_hashes(_gather(data, begin[first:last], n)), at, at + n)
        first = last
    return out


def _collapse(data, begin, length, segment: dict) -> tuple[np.ndarray, np.ndarray]:
    """Of equal segments the earliest: its row numbers, and those of the copies it covers.

    A row at the earliest place of its kind in another version of the same id is kept too: it starts no earlier.
    """
    size = segment["n"].astype(np.int64) + length - 1
    content = _hashes(data, begin, size)
    order = np.lexsort((segment["version"], segment["start"], segment["id"], size, segment["anchor"], content))
    a, b = order[:-1], order[1:]
    same = (content[a] == content[b]) & (size[a] == size[b]) & (segment["anchor"][a] == segment["anchor"][b])
    first = np.maximum.accumulate(np.where(np.concatenate([[True], ~same]), np.arange(len(order)), 0))
    lead = order[first]
    tied = (segment["id"][lead] == segment["id"][order]) & (segment["start"][lead] == segment["start"][order])
    twin = tied & np.concatenate([[False], same & (segment["version"][a] == segment["version"][b])])
    kept = (np.arange(len(order)) == first) | (tied & ~twin)
    return order[kept], order[~kept & ~twin]


def _segments(length: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per batch and shard: the different segments of repeated anchors, and the copies they cover."""
        for batch in batches:
            ids, texts = _ids(batch.column(0)), texts_of(batch.column(1))
            versions = batch.column(2).to_numpy()
            wanted = batch.column(3).flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            at = np.asarray(batch.column(3).offsets) - batch.column(3).offsets[0].as_py()
            names = np.sort(mix(np.repeat(np.arange(len(batch), dtype=np.uint64), np.diff(at)) << np.uint64(32) | wanted))
            for first, skipped, piece in _chunks(texts, length):
                anchors, text, begin, n, inner = segments_of(piece, length)
                name = mix((first + text).astype(np.uint64) << np.uint64(32) | _brief(anchors).astype(np.uint64))
                place = np.searchsorted(names, name)
                place[place == len(names)] = 0
                hit = names[place] == name if len(names) else np.zeros(0, bool)
                if not hit.any():
                    continue
                anchors, text, begin, n, inner = anchors[hit], text[hit], begin[hit], n[hit], inner[hit].astype(np.uint8)
                start = begin - piece.starts[text] + skipped
                segment = dict(zip(_SEGMENT, (ids[first + text], versions[first + text], start, n.astype(np.int32),
                                              anchors, inner), strict=True))
                kept, covered = _collapse(piece.data, begin, length, segment)
                shard = shard_of(anchors, shards)
                whole = dict(split_by(shard[kept], shards, kept))
                copies = dict(split_by(shard[covered], shards, covered))
                for k in sorted(whole.keys() | copies.keys()):
                    mine = whole.get(k, [kept[:0]])[0]
                    copy = copies.get(k, [covered[:0]])[0]
                    content = _gather(piece.data, begin[mine], n[mine] + length - 1)
                    row = [content, *(c[mine] for c in segment.values())]
                    row += [segment[c][copy] for c in ("id", "version", "start", "n")]
                    yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), *(binary([c]) for c in row)], names=_ROW)

    return run


_ROW = ["shard", "content", *_SEGMENT, "copy_id", "copy_version", "copy_start", "copy_n"]


def _marked(content, begin, n, anchor, where, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings of a shard's segments that start earlier elsewhere: their segments and offsets, from the suffix array.

    ``where`` ranks segments by the place of their first string; ``begin`` is where each lies in ``content``.
    """
    size = n.astype(np.int64) + length - 1
    text = np.ones(len(content) + len(n) + 1, np.uint16)
    at = begin + np.arange(len(n))  # one mark between segments
    text[np.repeat(at - begin, size) + np.arange(len(content))] = content.astype(np.uint16) + 2
    text[-1] = 0
    order = suffix_order(text, length)
    owner = np.repeat(np.arange(len(n)), size + 1)
    owner = np.concatenate([owner, [len(n) - 1]])
    offset = np.arange(len(text)) - at[owner]
    order = order[offset[order] < n[owner[order]]]  # suffixes that begin a string
    plain = np.where(text > 1, text - 2, 0).astype(np.uint8)
    equal = common_prefixes_reach(plain, order[1:], order[:-1], length) if len(order) > 1 else np.zeros(0, bool)
    group = np.cumsum(np.concatenate([[0], ~equal]))
    ids, starts = where
    string_id, string_start = ids[owner[order]], starts[owner[order]] + offset[order]
    rank = np.lexsort((string_start, string_id, group))
    g, i, s = group[rank], string_id[rank], string_start[rank]
    lead = np.maximum.accumulate(np.where(np.concatenate([[True], g[1:] != g[:-1]]), np.arange(len(g)), 0))
    later = (i != i[lead]) | (s != s[lead])
    marked = order[rank[later]]
    return owner[marked], offset[marked]


def _spans(length: int):
    def run(table: pa.Table) -> pa.Table:
        """Runs of bytes of each text that a shard's strings remove."""
        segment = {name: joined(table[name], kind) for name, kind in _SEGMENT.items()}
        content = joined(table["content"], np.uint8)
        size = segment["n"].astype(np.int64) + length - 1
        begin = np.cumsum(size) - size
        out = [[joined(table[f"copy_{c}"], _SEGMENT[c]) for c in ("id", "version", "start", "n")]]
        if len(size):
            kept, covered = _collapse(content, begin, length, segment)
            out.append([segment[c][covered] for c in ("id", "version", "start", "n")])
            kept = kept[np.argsort(segment["anchor"][kept], kind="stable")]
            # A segment alone with its anchor, which it holds once, has no equal strings to be found.
            anchor = segment["anchor"][kept]
            several = segment["inner"][kept] > 0
            several[1:] |= anchor[1:] == anchor[:-1]
            several[:-1] |= anchor[1:] == anchor[:-1]
            kept = kept[several]
            # Arrays of bounded size; the segments of one anchor stay together.
            anchor = segment["anchor"][kept]
            filled = np.cumsum(size[kept])
            first = 0
            while first < len(kept):
                room = filled[first] - size[kept[first]] + ARRAY
                last = max(int(np.searchsorted(filled, room, "right")), first + 1)
                last = int(np.searchsorted(anchor, anchor[last - 1], "right"))
                part = kept[first:last]
                here = _gather(content, begin[part], size[part])
                n = segment["n"][part].astype(np.int64)
                owner, offset = _marked(
                    here, np.cumsum(size[part]) - size[part], n, anchor[first:last],
                    (segment["id"][part], segment["start"][part]), length,
                )
                owner = part[owner]
                order = np.lexsort((offset, owner))
                owner, offset = owner[order], offset[order]
                fresh = np.ones(len(owner), bool)
                fresh[1:] = (owner[1:] != owner[:-1]) | (offset[1:] != offset[:-1] + 1)
                at = np.flatnonzero(fresh)
                run = np.diff(np.concatenate([at, [len(owner)]]))
                out.append([segment["id"][owner[at]], segment["version"][owner[at]],
                            segment["start"][owner[at]] + offset[at], run])
                first = last
        ids, versions, start, n = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"key": ids, "version": versions, "begin": start, "end": start + n + length - 1})

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = texts_of(batch.column("text"))
        versions = batch.column("version").to_pylist()
        removed, runs, kept, digest, spans = [], [], [], [], []
        for i, marks in enumerate(batch.column("spans").to_pylist()):
            text, merged = texts.text(i), []
            for begin, end in sorted((m["begin"], m["end"]) for m in marks if m["version"] == versions[i]):
                if merged and begin <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], end)
                else:
                    merged.append([begin, end])
            edges = [0, *(e for m in merged for e in m), len(text)]
            rest = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
            removed.append(len(text) - len(rest))
            runs.append(len(merged))
            kept.append(rest)
            digest.append(hashlib.sha256(rest).hexdigest())
            spans.append([{"begin": a, "end": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays(
            [batch.column("key"), batch.column("version"), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
             pa.array(digest, pa.string()), pa.array(spans, pa.list_(_SPAN)), pa.array(kept, pa.binary())],
            names=["key", "version", "n_removed", "n_spans", "kept_sha256", "spans", "kept"],
        )


_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])


def repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The texts that lose bytes: key (the id), version (hash of the text), spans removed and bytes kept."""
    if length < SEED + 1:
        raise ValueError(f"strings of more than {SEED} bytes")
    # Several shards for each task of a shuffle: a group is what a task holds at once.
    shards = 12 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(int(np.iinfo(np.int64).min)))
    source = docs.select(key.alias("key"), text.alias("text"), F.xxhash64(text).alias("version"))

    sent = source.mapInArrow(_anchors(length, shards), "shard int, anchor binary, holder binary, role binary")
    held = sent.groupBy("shard").applyInArrow(_repeated, "key long, anchor long")
    held = materialize(held.groupBy("key").agg(F.collect_set("anchor").alias("anchors")), "anchors")
    # Filters on what is always true of few rows let Spark sieve the documents by them before it shuffles texts.
    few = held.where(F.size("anchors") > 0)
    segments = source.join(few, "key").select("key", "text", "version", "anchors").mapInArrow(
        _segments(length, shards), ", ".join(f"{c} {'int' if c == 'shard' else 'binary'}" for c in _ROW)
    )
    spans = segments.groupBy("shard").applyInArrow(_spans(length), "key long, version long, begin long, end long")
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("version", "begin", "end")).alias("spans"))
    spans = materialize(spans, "spans").where(F.size("spans") > 0)
    schema = (
        "key long, version long, n_removed long, n_spans long, kept_sha256 string, "
        "spans array<struct<begin:long, end:long>>, kept binary"
    )
    return source.join(spans, "key").mapInArrow(_cut, schema).where("n_removed > 0").dropDuplicates(["key", "version"])


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_bytes, n_removed, n_spans, kept_sha256 and the removed spans (bytes)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    whole = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(np.iinfo(np.int64).min))).alias("key"),
        F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("version"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text, 256).alias("whole_sha256"),
    )
    cut = repeats(docs, length, id_col, text_col).drop("kept")
    return whole.join(cut, ["key", "version"], "left").select(
        F.col("id").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
        F.coalesce("spans", F.array()).alias("spans"),
    )
