"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays, mapped by the scorers.

A text is its words (lower-cased in A-Z) and one end. Word pairs are counted by batch, dealt to shards by the hash of
the pair and summed there, so a frequent word's pairs spread over all shards. A shard writes its pairs as sorted
hashes with counts, and returns for each word how many kinds of pairs it begins (seen once, twice, more often), how many
tokens follow it and how many kinds of words precede it; these are summed by shards of word hashes and written the same
way. The driver sees only sums: tokens, words, and counts of counts for the discounts. Scoring maps the arrays
and looks every token of a piece of text up in them, in sorted order, shard by shard.

The model is of order two: a pair table takes about as much room as the text. Words and pairs are told apart by 64-bit hashes.

Defined results: a null or empty text is one end token. Without any training text every word is unknown and scores
one over one. Rows are scored one by one, so repeated rows repeat; each training row counts; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.kernels import (
    BLANKS,
    joined,
    mix,
    packed,
    pieces,
    shard_of,
    split_by,
    texts_of,
    unpacked,
    word_hashes,
    words,
)
from larkspur.store import load, save
from larkspur.workspace import materialize, new_path

START = np.uint64(0x5BD1E9955BD1E995)
END = np.uint64(0xC2B2AE3D27D4EB4F)
#: Distinct pairs a task holds before it passes them on.
HELD = 1_500_000
#: Pair counts from here on are kept apart.
OFTEN = 255
_PAIR = {"left": np.uint64, "right": np.uint64, "n": np.uint32}
#: Kinds of pairs begun that were seen once, twice, more often; tokens after it; kinds of words before it; its tokens.
_WORD = {"word": np.uint64, "n1": np.uint32, "n2": np.uint32, "n3": np.uint32, "after": np.int64, "before": np.uint32,
         "count": np.int64}


def pair_hash(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + mix(right))


def sequences(piece) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of start, words and end of each text, one text after the other, and where each text begins."""
    found = words(piece, BLANKS)
    first = found.first + 2 * np.arange(len(found.first))
    out = np.empty(first[-1], np.uint64)
    out[np.arange(len(found)) + 2 * found.text + 1] = word_hashes(piece, found)
    out[first[:-1]] = START
    out[first[1:] - 1] = END
    return out, first


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, one place of each, and the sum of n for each."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], order[first], np.add.reduceat(n[order].astype(np.int64), first) if len(first) else first


def _pairs(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0

        def settle() -> list[np.ndarray]:
            left, right, n = (np.concatenate(c) for c in zip(*held, strict=True))
            _, at, n = _summed(pair_hash(left, right), n)
            return [left[at], right[at], n.astype(np.uint32)]

        def passed_on() -> pa.RecordBatch:
            left, right, n = settle()
            order = np.argsort(left, kind="stable")  # equal words stand together and compress
            left, right, n = left[order], right[order], n[order]
            dealt = list(split_by(shard_of(pair_hash(left, right), shards), shards, left, right, n))
            columns = [[packed(c[0], True), c[1].tobytes(), packed(c[2])] for _, c in dealt]
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in dealt], pa.int32()), *(pa.array(c, pa.binary()) for c in zip(*columns, strict=True))],
                names=["shard", *_PAIR],
            )

        for batch in batches:
            for _, piece in pieces(texts_of(batch.column(0))):
                tokens, _ = sequences(piece)
                inside = tokens[:-1] != END
                left, right = tokens[:-1][inside], tokens[1:][inside]
                _, at, n = _summed(pair_hash(left, right), np.ones(len(left), np.uint32))
                held.append([left[at], right[at], n.astype(np.uint32)])
                size += len(at)
                if size > HELD:
                    held = [settle()]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield passed_on()
                        held, size = [], 0
        if held:
            yield passed_on()

    return run


def _count_pairs(model: str, word_shards: int):
    def run(table: pa.Table) -> pa.Table:
        left = np.concatenate([unpacked(v, np.uint64, True) for v in table["left"].to_pylist()])
        right = joined(table["right"], np.uint64)
        n = np.concatenate([unpacked(v, np.uint32) for v in table["n"].to_pylist()])
        key, at, n = _summed(pair_hash(left, right), n)
        left, right = left[at], right[at]
        shard = table["shard"][0].as_py()
        save(model, f"pair-{shard}", key)
        # Counts in a byte; the few that need more stand in a table of their own.
        save(model, f"times-{shard}", np.minimum(n, OFTEN).astype(np.uint8))
        save(model, f"often-{shard}", key[n >= OFTEN])
        save(model, f"often_n-{shard}", n[n >= OFTEN])
        word, role = np.unique(np.concatenate([left, right]), return_inverse=True)
        begun, met = role[: len(left)], role[len(left) :]
        size = len(word)
        kinds = [np.bincount(begun[m], minlength=size) for m in (n == 1, n == 2, n > 2)]
        after = np.bincount(begun, n, size).astype(np.int64)
        before, count = np.bincount(met, minlength=size), np.bincount(met, n, size).astype(np.int64)
        columns = [c.astype(t) for c, t in zip([word, *kinds, after, before, count], _WORD.values(), strict=True)]
        dealt = list(split_by(shard_of(mix(word), word_shards), word_shards, *columns))
        of_counts = [int(np.count_nonzero(n == k)) for k in (1, 2, 3, 4)]
        rows = len(dealt)
        return pa.table(
            [
                pa.array([k for k, _ in dealt], pa.int32()),
                *(pa.array([packed(c[j], j == 0) for _, c in dealt], pa.binary()) for j in range(len(_WORD))),
                *(pa.array([k] + [0] * (rows - 1), pa.int64()) for k in of_counts),
            ],
            names=["shard", *_WORD, "r1", "r2", "r3", "r4"],
        )

    return run


def _count_words(model: str):
    def run(table: pa.Table) -> pa.Table:
        columns = [
            np.concatenate([unpacked(v, kind, name == "word") for v in table[name].to_pylist()])
            for name, kind in _WORD.items()
        ]
        # Shards are ranges of the mixed hash; within one, words are kept in the order of that hash.
        key = mix(columns[0])
        order = np.argsort(key, kind="stable")
        key = key[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        shard = table["shard"][0].as_py()
        save(model, f"word-{shard}", key[first])
        summed = {}
        for (name, kind), column in list(zip(_WORD.items(), columns, strict=True))[1:]:
            summed[name] = np.add.reduceat(column[order].astype(np.int64), first)
            save(model, f"{name}-{shard}", summed[name].astype(kind))
        before, count = summed["before"], summed["count"]
        facts = [np.count_nonzero(before == k) for k in (1, 2, 3, 4)]
        facts += [before.sum(), np.count_nonzero(before), np.count_nonzero(count), count.sum()]
        return pa.table([pa.array([int(f)], pa.int64()) for f in facts], names=_FACTS)

    return run


_FACTS = ["r1", "r2", "r3", "r4", "kinds", "preceded", "words", "tokens"]


def discounts(r1: int, r2: int, r3: int, r4: int) -> np.ndarray:
    """What is taken from counts of 0, 1, 2 and 3 or more, from how many have the counts 1 to 4.

    Where one of these is empty the closed form has no value; then the share r1 / (r1 + 2 r2), or one half, is taken.
    """
    y = r1 / (r1 + 2 * r2) if r1 else 0.5
    forms = [1 - 2 * y * r2 / r1 if r1 else y, 2 - 3 * y * r3 / r2 if r2 else y, 3 - 4 * y * r4 / r3 if r3 else y]
    return np.array([0.0, *(d if 0 < d < k else y for k, d in enumerate(forms, 1))])


class Scorer:
    """The mapped arrays of a model."""

    def __init__(self, model: str, shards: int, word_shards: int, facts: dict):
        self.facts = facts
        self.pair = [load(model, f"pair-{k}", np.uint64) for k in range(shards)]
        self.times = [load(model, f"times-{k}", np.uint8) for k in range(shards)]
        self.often = [load(model, f"often-{k}", np.uint64) for k in range(shards)]
        self.often_n = [load(model, f"often_n-{k}", np.int64) for k in range(shards)]
        self.word = [load(model, f"word-{k}", np.uint64) for k in range(word_shards)]
        self.of_word = {
            name: [load(model, f"{name}-{k}", kind) for k in range(word_shards)]
            for name, kind in list(_WORD.items())[1:]
        }

    def _find(self, arrays: list[np.ndarray], hashes: np.ndarray, wanted: list[list[np.ndarray]]) -> list[np.ndarray]:
        """For sorted hashes, the wanted numbers beside each in its shard; 0 where it is absent."""
        out = [np.zeros(len(hashes), np.float64) for _ in wanted]
        edges = np.searchsorted(shard_of(hashes, len(arrays)), np.arange(len(arrays) + 1))
        for k in np.flatnonzero(np.diff(edges)):
            held, needles = arrays[k], hashes[edges[k] : edges[k + 1]]
            if not len(held):
                continue
            at = np.searchsorted(held, needles)
            at[at == len(held)] = 0
            hit = np.flatnonzero(held[at] == needles)
            for numbers, column in zip(out, wanted, strict=True):
                numbers[edges[k] + hit] = column[k][at[hit]]
        return out

    def score(self, piece) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens, known tokens, base score, model score."""
        f = self.facts
        tokens, first = sequences(piece)
        word, place = np.unique(mix(tokens), return_inverse=True)
        n1, n2, n3, after, before, count = self._find(self.word, word, [self.of_word[n] for n in list(_WORD)[1:]])
        low, high = np.array(f["low"]), np.array(f["high"])
        # Kinds of words before a word, interpolated with one share for each word and one for all unknown ones.
        if f["kinds"]:
            uniform = (low[1] * f["r1"] + low[2] * f["r2"] + low[3] * (f["preceded"] - f["r1"] - f["r2"])) / f["kinds"]
            alone = (before - low[np.minimum(before, 3).astype(int)]) / f["kinds"] + uniform / (f["words"] + 1)
        else:
            alone = np.full(len(word), 1.0)
        share = np.divide(high[1] * n1 + high[2] * n2 + high[3] * n3, after, out=np.ones(len(word)), where=after > 0)
        inside = np.flatnonzero(tokens[:-1] != END)
        left, right = place[inside], place[inside + 1]
        pairs = pair_hash(tokens[inside], tokens[inside + 1])
        order = np.argsort(pairs)
        pairs, times = pairs[order], np.zeros(len(pairs))
        found = self._find(self.pair, pairs, [self.times])[0]
        often = found == OFTEN
        found[often] = self._find(self.often, pairs[often], [self.often_n])[0]
        times[order] = found
        direct = times - high[np.minimum(times, 3).astype(int)]
        direct = np.divide(direct, after[left], out=np.zeros(len(pairs)), where=after[left] > 0)
        model = np.log10(direct + share[left] * alone[right])
        base = np.log10((count + 0.1) / (f["tokens"] + 0.1 * (f["words"] + 1)))[right]
        known = (count > 0)[right]
        edges = first[:-1] - np.arange(len(first) - 1)  # each text has one token less than entries
        sums = [np.add.reduceat(c.astype(np.float64), edges) for c in (known, base, model)]
        return np.diff(first) - 1, sums[0].astype(np.int64), sums[1], sums[2]


@lru_cache(maxsize=1)
def _scorer(model: str, shards: int, word_shards: int, facts: tuple) -> Scorer:
    return Scorer(model, shards, word_shards, dict(facts))


class KneserNey:
    """A fitted model: where its arrays are, and its sums."""

    def __init__(self, spark: SparkSession, path: str, shards: int, word_shards: int, facts: dict):
        self.spark, self.path, self.shards, self.word_shards, self.facts = spark, path, shards, word_shards, facts

    @classmethod
    def fit(cls, docs: DataFrame, text_col: str = "text") -> KneserNey:
        """Count every row of ``docs``."""
        spark = docs.sparkSession
        # Several shards for each task of a shuffle: a group is what a task holds at once.
        word_shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
        shards = 4 * word_shards
        model = new_path(spark, "model")
        texts = docs.select(F.col(text_col).cast("string").alias("text"))
        pairs = texts.mapInArrow(_pairs(shards), "shard int, left binary, right binary, n binary")
        schema = "shard int, " + ", ".join(f"{n} binary" for n in _WORD) + ", r1 long, r2 long, r3 long, r4 long"
        by_word = materialize(pairs.groupBy("shard").applyInArrow(_count_pairs(model, word_shards), schema), "words")
        high = by_word.agg(*(F.coalesce(F.sum(r), F.lit(0)).alias(r) for r in ("r1", "r2", "r3", "r4"))).first()
        facts = by_word.select("shard", *_WORD).groupBy("shard").applyInArrow(
            _count_words(model), ", ".join(f"{n} long" for n in _FACTS)
        )
        low = facts.agg(*(F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in _FACTS)).first().asDict()
        rates = {"high": tuple(discounts(*high).tolist())}
        rates["low"] = tuple(discounts(low["r1"], low["r2"], low["r3"], low["r4"]).tolist())
        return cls(spark, model, shards, word_shards, low | rates)

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Per row: n_tokens, n_known, base_score, score (log10) and perplexity."""
        made = (self.path, self.shards, self.word_shards, tuple(sorted(self.facts.items())))
        source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scorer = _scorer(*made)
            for batch in batches:
                parts = [scorer.score(piece) for _, piece in pieces(texts_of(batch.column(1)))]
                columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0)] * 4
                n, known, base, score = columns
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n.astype(np.int64)), pa.array(known.astype(np.int64)), pa.array(base),
                     pa.array(score), pa.array(10 ** (-score / np.maximum(n, 1)))],
                    names=["id", "n_tokens", "n_known", "base_score", "score", "perplexity"],
                )

        kind = source.schema["id"].dataType.simpleString()
        schema = f"id {kind}, n_tokens long, n_known long, base_score double, score double, perplexity double"
        return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
