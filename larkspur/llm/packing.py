"""Documents packed into as few token sequences of bounded length as best-fit decreasing finds.

Best fit decreasing puts pieces, longest first, into the open sequence with the least room that is enough. It looks at
lengths alone, so the counts of pieces by length (at most ``capacity`` numbers, whatever the size of the corpus) decide
where every piece goes. ``best_fit`` walks the lengths downwards over a segment tree of remaining capacities; pieces of one
length that fill open sequences of one remaining capacity are one step, a *run*, which places exactly what the loop over
single pieces would place. A run of sequences at least halves its room with each step that fills it, so there are at most
some ``capacity * log2(capacity)`` runs. Spark does the rest: it cuts and numbers pieces, counts lengths, and looks up the run
of each piece.

A tokenizer that never lets a token cross white space is applied to each distinct word once; any other to whole texts.

Defined results: null and empty texts are the end id alone. Repeated rows and ids are packed row by row. Other columns
are ignored. An empty table has no pieces. Pieces of one length are placed in the order of the tasks that read them.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator, Mapping
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.kernels import BLANKS, pieces, texts_of
from larkspur.workspace import materialize

#: Bytes of text cut into words at a time.
PIECE = 1 << 20
#: Bytes of words and ids that a worker remembers, and of an entry besides them; only speed depends on it.
REMEMBERED = 384 << 20
ENTRY = 180

#: Steps of a tokenizer file after which no token holds or depends on white space.
SAFE_NORMALIZERS = {"NFC", "NFD", "Lowercase", "Replace"}
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def keeps_to_words(tokenizer: Mapping) -> bool:
    """Whether a tokenizer file drops white space before it makes tokens, so that words can be encoded one by one."""
    normal = tokenizer.get("normalizer") or {"type": "Sequence", "normalizers": []}
    normal = normal["normalizers"] if normal["type"] == "Sequence" else [normal]
    split = tokenizer.get("pre_tokenizer") or {}
    split = split["pretokenizers"][0] if split.get("type") == "Sequence" else split
    return (
        all(n["type"] in SAFE_NORMALIZERS for n in normal)
        and all(n.get("pattern") == {"Regex": r"\s+"} and n["content"] == " " for n in normal if n["type"] == "Replace")
        and split.get("type") == "Split"
        and (split["behavior"], split["invert"]) == ("Removed", True)
        and split["pattern"] == {"Regex": WORD_PATTERN}
        and all(not (a["lstrip"] or a["rstrip"]) and len(a["content"].split()) == 1 for a in tokenizer["added_tokens"])
    )


class Encoder:
    """Token ids of texts, as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.by_word = keeps_to_words(described)
        # A special token stands between words that are encoded in one go, and shows where each one's ids end.
        marks = [a for a in described["added_tokens"] if a["special"] and not (a["normalized"] or a["single_word"])]
        self.mark, self.mark_id = (marks[0]["content"].encode(), marks[0]["id"]) if marks else (None, -1)
        steps = (described.get("normalizer") or {}).get("normalizers", [])
        self.lowers = self.by_word and self.mark is not None and {"type": "Lowercase"} in steps
        self.lowers = self.lowers and all(a["content"].encode()[:1] == self.mark[:1] for a in described["added_tokens"])
        self.known: dict[bytes, bytes] = {}
        self.bytes = 0

    def _encode(self, parts: list[bytes]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast([p.decode() for p in parts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _encode_words(self, words: list[bytes]) -> list[bytes]:
        ids = np.frombuffer(self._encode([self.mark.join(words)])[0], "<u4")
        ends = np.flatnonzero(ids == self.mark_id)
        starts, raw = [0, *(4 * ends + 4).tolist()], ids.tobytes()
        return [raw[a:b] for a, b in zip(starts, [*(4 * ends).tolist(), len(raw)], strict=True)]

    def _words(self, texts: list[list[bytes]]) -> list[bytes]:
        fresh = list(set().union(*texts).difference(self.known))
        for k in range(0, len(fresh), 10_000):
            part = fresh[k : k + 10_000]
            # A word with the mark's first byte of its own could be taken for a mark.
            alone = self.mark is None or self.mark.join(part).count(self.mark[:1]) != len(part) - 1
            found = self._encode(part) if alone else self._encode_words(part)
            self.known.update(zip(part, found, strict=True))
            self.bytes += sum(map(len, part)) + sum(map(len, found)) + ENTRY * len(part)
        found = [b"".join(map(self.known.__getitem__, words)) for words in texts]
        if self.bytes > REMEMBERED:
            self.known, self.bytes = {}, 0
        return found

    def _long(self, raw: bytes) -> bytes:
        """A text of more than a piece, cut at blanks."""
        parts, first = [], 0
        blank = np.flatnonzero(BLANKS[np.frombuffer(raw, np.uint8)])
        while first < len(raw):
            at = np.searchsorted(blank, first + PIECE)
            last = int(blank[at]) if at < len(blank) else len(raw)
            parts += self._words([raw[first:last].split()])
            first = last
        return b"".join(parts)

    def ids(self, texts: list[bytes]) -> list[bytes]:
        if not self.by_word:
            return self._encode(texts)
        if self.lowers:
            # Special tokens are found before letters are made small, so texts that may hold one stay as they are.
            texts = [t if self.mark[:1] in t else t.lower() for t in texts]
        if len(texts) == 1 and len(texts[0]) > PIECE:
            return [self._long(texts[0])]
        return self._words([t.split() for t in texts])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def token_pieces(
    docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """A row per piece of at most ``capacity`` tokens: id, piece, start, length, ids_crc32, on request ids, and its place among
    the pieces of its length that one task made (``_task``, ``_nth``). Write it before use: the places are those of one run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(path), np.array([end_id], "<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            texts = texts_of(batch.column(1))
            for first, part in pieces(texts, PIECE):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, raw in enumerate(own.ids([part.text(k) for k in range(len(part))]), first):
                    raw += end
                    for k, begin in enumerate(range(0, len(raw), 4 * capacity)):
                        cut = raw[begin : begin + 4 * capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(begin // 4)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        if with_ids:
                            ids.append(cut)
                lengths = np.array(length, np.int64)
                order = np.argsort(lengths, kind="stable")
                place = np.empty(len(lengths), np.int64)
                place[order] = np.arange(len(lengths)) - np.searchsorted(lengths[order], lengths[order])
                place += seen[lengths]
                seen += np.bincount(lengths, minlength=capacity + 1)
                columns = [
                    batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(lengths), pa.array(crc, pa.int64()),
                    pa.array(np.full(len(row), task, np.int32)), pa.array(place),
                ]
                names = ["id", "piece", "start", "length", "ids_crc32", "_task", "_nth"]
                if with_ids:
                    columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    source = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long, _task int, _nth long"
    return source.mapInArrow(run, schema + ", ids binary" * with_ids).withColumnRenamed("id", id_col)


class OpenSequences:
    """Runs of equally full sequences, and a segment tree that finds the least remaining capacity that is enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.tree = bytearray(2 * self.size)
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]

    def _mark(self, room: int, on: int) -> None:
        at = room + self.size
        while at and self.tree[at] != on:
            self.tree[at] = on
            at >>= 1
            on = self.tree[2 * at] | self.tree[2 * at + 1]

    def add(self, room: int, first: int, n: int) -> None:
        if room and n:
            self.runs[room].append((first, n))
            self._mark(room, 1)

    def tightest(self, length: int) -> int | None:
        """The least remaining capacity of at least ``length`` that some open sequence has."""
        at = length + self.size
        while not self.tree[at]:
            # To the next subtree on the right, as far up as needed.
            while at & 1:
                at >>= 1
            if at == 0:
                return None
            at += 1
            if at & (at - 1) == 0:
                return None
        while at < self.size:
            at = 2 * at if self.tree[2 * at] else 2 * at + 1
        return at - self.size

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            self._mark(room, 0)
        return run


def best_fit(counts: Mapping[int, int], capacity: int) -> tuple[np.ndarray, int]:
    """Best-fit decreasing over pieces counted by length: its runs, and the number of sequences.

    Pieces are numbered from 0, longest first. A run is (number of its first piece, length, pieces for each sequence, first
    sequence, tokens already in each of them); it goes on to the next run's first piece.
    """
    open_, runs, number, sequences = OpenSequences(capacity), [], 0, 0

    def place(n: int, length: int, each: int, first: int, room: int) -> None:
        nonlocal number
        if n:
            runs.append((number, length, each, first, capacity - room))
            number += n * each
            open_.add(room - each * length, first, n)

    for length in sorted(counts, reverse=True):
        left = counts[length]
        if not 1 <= length <= capacity:
            raise ValueError(f"a piece of {length} tokens does not fit into {capacity}")
        while left:
            room = open_.tightest(length)
            if room is None:
                room, first = capacity, sequences
                n = -(-left // (capacity // length))
                sequences += n
            else:
                first, n = open_.take(room)
            # The sequence that has just taken a piece is the tightest for the next one for as long as it has room.
            each = room // length
            full = min(n, left // each)
            place(full, length, each, first, room)
            left -= full * each
            if full < n and left:
                place(1, length, left, first + full, room)
                full, left = full + 1, 0
            open_.add(room, first + full, n - full)
    return np.array(runs, np.int64).reshape(-1, 5), sequences


def pack_documents(
    docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``; sequences are filled from 0 without gaps."""
    spark = docs.sparkSession
    cut = materialize(token_pieces(docs, path, capacity, end_id, id_col, text_col, with_ids), "pieces")
    counts = materialize(cut.groupBy("_task", "length").agg(F.count("*").alias("_n")), "lengths")
    # At most one row per length.
    by_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    runs, _ = best_fit(by_length, capacity)
    shared = spark.sparkContext.broadcast(np.ascontiguousarray(runs.T))
    # Pieces of one length are numbered task by task: a row per task and length.
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select("_task", "length", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_ahead"))
    longer, total = {}, 0
    for length in sorted(by_length, reverse=True):
        longer[length], total = total, total + by_length[length]
    before = np.zeros(capacity + 1, np.int64)
    before[list(longer)] = list(longer.values())
    numbered = cut.join(ahead, ["_task", "length"]).withColumn("_nth", F.col("_nth") + F.col("_ahead"))
    kept = [id_col, "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    numbered = numbered.select(*kept, "_nth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, length, each, sequence, used = shared.value
        for batch in batches:
            own = batch.column(3).to_numpy()
            number = before[own] + batch.column(batch.num_columns - 1).to_numpy()
            at = np.searchsorted(first, number, "right") - 1
            inside = number - first[at]
            columns = [
                *batch.columns[:-1],
                pa.array(sequence[at] + inside // each[at]),
                pa.array(used[at] + inside % each[at] * own),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "sequence_id", "offset"])

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in numbered.schema.fields[:-1])
    return numbered.mapInArrow(run, types + ", sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id`` and ``ids`` (little-endian unsigned 32-bit), from pieces with ids.

    A group holds at most one sequence's tokens.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (
        packed.groupBy("sequence_id")
        .agg(parts.alias("parts"))
        .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
    )
