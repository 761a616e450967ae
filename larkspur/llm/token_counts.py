"""Exact token counts of every prefix of a text, for truncation and budget questions without encoding again.

A tokenizer that drops white space and never lets a token cross it counts a text as the sum over its words. So the
dynamic programme is C[k] = C[k - 1] + c(word k): one running total at the end of each word. Each distinct word of a
piece of text is encoded once by the tokenizer's own library. ``PrefixCounts`` answers any prefix from the table: the
running total before the word the prefix ends in, and the count of that one part of a word.

Defined results: null and empty texts, and texts of white space alone, have 0 tokens and are never over a limit. Rows
are counted one by one, so repeated rows and ids give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larkspur.llm.kernels import Texts, pieces, range_hashes, prefix_hashes, texts_of, words

#: Distinct words a worker remembers between pieces; only speed depends on it.
REMEMBERED = 1 << 20
PIECE = 8 << 20


class WordTokens:
    """Token counts of words by one tokenizer file; remembers the words it has met."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.hashes = np.zeros(0, np.uint64)
        self.tokens = np.zeros(0, np.int64)

    def encode(self, parts: list[str]) -> np.ndarray:
        encoded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return np.fromiter((len(e) for e in encoded), np.int64, len(parts))

    def counts(self, texts: Texts, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Tokens of each word, given by its byte range."""
        hashes = range_hashes(prefix_hashes(texts.data), begin, end)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        tokens = np.zeros(len(distinct), np.int64)
        place = np.searchsorted(self.hashes, distinct)
        place[place == len(self.hashes)] = 0
        known = self.hashes[place] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        if len(self.hashes):
            tokens[known] = self.tokens[place[known]]
        fresh = np.flatnonzero(~known)
        raw = texts.data.tobytes()
        for k in range(0, len(fresh), 10_000):
            part = fresh[k : k + 10_000]
            tokens[part] = self.encode([raw[begin[i] : end[i]].decode() for i in at[part]])
        if len(self.hashes) + len(fresh) > REMEMBERED:
            self.hashes, self.tokens = distinct, tokens
        else:
            merged = np.concatenate([self.hashes, distinct[fresh]])
            order = np.argsort(merged, kind="stable")
            self.hashes, self.tokens = merged[order], np.concatenate([self.tokens, tokens[fresh]])[order]
        return tokens[inverse]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    return WordTokens(path)


class PrefixCounts:
    """The table of one text: byte ranges of its words and the token total at each word's end."""

    def __init__(self, text: str | None, path: str):
        self.raw, self.counter = (text or "").encode(), word_tokens(path)
        texts = Texts(np.frombuffer(self.raw, np.uint8), np.array([0, len(self.raw)]))
        found = words(texts)
        self.begin, self.end = found.begin, found.end
        self.totals = np.concatenate([[0], np.cumsum(self.counter.counts(texts, found.begin, found.end))])

    def at(self, n_bytes: int) -> int:
        """Tokens of the first ``n_bytes`` bytes (an end of a character)."""
        whole = int(np.searchsorted(self.end, n_bytes, "right"))
        if whole == len(self.end) or self.begin[whole] >= n_bytes:
            return int(self.totals[whole])
        return int(self.totals[whole] + self.counter.encode([self.raw[self.begin[whole] : n_bytes].decode()])[0])

    def within(self, budget: int) -> int:
        """Bytes of the longest run of leading words of at most ``budget`` tokens."""
        whole = int(np.searchsorted(self.totals, budget, "right")) - 1
        return int(self.end[whole - 1]) if whole > 0 else 0


def token_counts(
    docs: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: bytes, tokens, whether over the limit, and the bytes of leading words that stay within it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = word_tokens(path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            n = np.zeros(len(texts), np.int64)
            kept = np.zeros(len(texts), np.int64)
            for first, piece in pieces(texts, PIECE):
                found = words(piece)
                totals = np.concatenate([[0], np.cumsum(counter.counts(piece, found.begin, found.end))])
                before = totals[found.first[:-1]]
                n[first : first + len(piece)] = totals[found.first[1:]] - before
                last = np.searchsorted(totals, before + limit, "right") - 1
                last = np.minimum(last, found.first[1:])
                some = last > found.first[:-1]
                ends = found.end[np.maximum(last, 1) - 1] if len(found) else np.zeros(len(piece), np.int64)
                kept[first : first + len(piece)] = np.where(some, ends - piece.starts[:-1], 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(texts.starts)), pa.array(n), pa.array(n > limit), pa.array(kept)],
                names=["id", "n_bytes", "n_tokens", "over_limit", "bytes_within"],
            )

    source = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, bytes_within long"
    return source.mapInArrow(run, schema).withColumnRenamed("id", id_col)
