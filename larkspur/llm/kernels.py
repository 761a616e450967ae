"""Array helpers on the UTF-8 bytes of one Arrow batch: words, word hashes, shingles, rolling hashes, packed rows.

All work on a ``Texts``: the bytes of several texts end to end, and where each begins. Texts are never cut; a batch is
taken in pieces of a megabyte or less so that a task needs memory for one piece (or one very long text), not for a batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
#: Pieces of steps that hold many arrays of words at once.
SMALL_PIECE = 1 << 18

#: Words as runs of bytes that are none of space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True
#: Words as runs of digits, ASCII letters and every byte of a non-ASCII character.
MARKS = np.ones(256, bool)
MARKS[0x80:] = False
MARKS[ord("0") : ord("9") + 1] = False
MARKS[ord("a") : ord("z") + 1] = False
MARKS[ord("A") : ord("Z") + 1] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = {False: np.ones(1, np.uint64), True: np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all bits."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BYTE_LOWER = _BYTE[LOWER]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the hash base (or of its inverse) modulo 2^64; kept for the next piece."""
    if len(_powers[inverse]) < n:
        base = np.full(max(1 << (n - 1).bit_length(), 1 << 18), _P_INVERSE if inverse else _P, np.uint64)
        base[0] = 1
        _powers[inverse] = np.multiply.accumulate(base)
    return _powers[inverse][:n]


@dataclass
class Texts:
    """Bytes of texts end to end; text i is data[starts[i]:starts[i + 1]]."""

    data: np.ndarray
    starts: np.ndarray

    def __len__(self) -> int:
        return len(self.starts) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.starts[i + 1]].tobytes()


def texts_of(column: pa.Array | pa.ChunkedArray) -> Texts:
    """The bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    starts = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(column) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    data = column.buffers()[2]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return Texts(data[starts[0] : starts[-1]], starts - starts[0])


def pieces(texts: Texts, size: int = PIECE) -> Iterator[tuple[int, Texts]]:
    """Runs of whole texts of about ``size`` bytes, each with the number of its first text."""
    first, n = 0, len(texts)
    while first < n:
        last = int(np.searchsorted(texts.starts, texts.starts[first] + size, "right")) - 1
        last = min(n, max(last, first + 1))
        a, b = texts.starts[first], texts.starts[last]
        yield first, Texts(texts.data[a:b], texts.starts[first : last + 1] - a)
        first = last


@dataclass
class Words:
    """Words of a piece: byte range of each, and where each text's words begin (one more entry than texts)."""

    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.begin)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """Number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(texts: Texts, separators: np.ndarray = BLANKS) -> Words:
    """Maximal runs of bytes that are no separators; a run never crosses from one text into the next."""
    inside = ~separators[texts.data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = texts.starts[:-1][texts.starts[:-1] < len(inside)]
    begins[edges] = inside[edges]
    edges = texts.starts[1:][texts.starts[1:] > 0] - 1
    ends[edges] = inside[edges]
    begin = np.flatnonzero(begins)
    return Words(begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, texts.starts))


def prefix_hashes(data: np.ndarray, lower: bool = False) -> np.ndarray:
    """Polynomial hash sums modulo 2^64 of every prefix (one more entry than bytes)."""
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * powers(len(data)), out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each byte range, by content and length alone."""
    shifted = (sums[end] - sums[begin]) * powers(len(sums), True)[begin]
    return mix(shifted + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(texts: Texts, found: Words, lower: bool = True) -> np.ndarray:
    return range_hashes(prefix_hashes(texts.data, lower), found.begin, found.end)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``width`` words, and where each text's runs begin.

    A text with fewer words, but not none, has its whole sequence as its one run.
    """
    counts = np.diff(first)
    runs = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(runs)])
    at = np.repeat(first[:-1] - begin[:-1], runs) + np.arange(begin[-1])
    stop = np.repeat(first[1:], runs)
    total = np.zeros(len(at), np.uint64)
    length = np.minimum(stop - at, width)
    padded = np.concatenate([hashes, np.zeros(width, np.uint64)])
    for k in range(width):
        total = total * _P + np.where(k < length, padded[at + k], np.uint64(0))
    return mix(total + length.astype(np.uint64)), begin


def text_hashes(texts: Texts) -> np.ndarray:
    """Hash of each whole text."""
    return range_hashes(prefix_hashes(texts.data), texts.starts[:-1], texts.starts[1:])


def split_by(key: np.ndarray, n: int, *columns: np.ndarray) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns dealt by ``key`` (0 to n - 1); only keys with rows."""
    order = np.argsort(key, kind="stable")
    edges = np.searchsorted(key[order], np.arange(n + 1))
    columns = [c[order] for c in columns]
    for k in np.flatnonzero(np.diff(edges)):
        yield int(k), [c[edges[k] : edges[k + 1]] for c in columns]


def shard_of(hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of n shards a hash belongs to, by its upper bits (so shards are ranges of the hash)."""
    return ((hashes >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int32)


def binary(parts: list[np.ndarray]) -> pa.Array:
    return pa.array([p.tobytes() for p in parts], pa.binary())


def joined(column: pa.ChunkedArray | pa.Array, dtype) -> np.ndarray:
    """The numbers of all binary values of a column, end to end."""
    parts = []
    for chunk in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        at = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset : chunk.offset + len(chunk) + 1]
        if len(at) > 1 and at[-1] > at[0]:
            parts.append(np.frombuffer(chunk.buffers()[2], np.uint8)[at[0] : at[-1]])
    return np.concatenate(parts).view(dtype) if parts else np.zeros(0, dtype)


def packed(numbers: np.ndarray, rising: bool = False) -> bytes:
    """Numbers by byte planes, so that the planes of small numbers compress to nothing; differences if they rise."""
    if rising:
        numbers = np.diff(numbers, prepend=numbers.dtype.type(0))
    return np.ascontiguousarray(numbers.view(np.uint8).reshape(len(numbers), numbers.dtype.itemsize).T).tobytes()


def unpacked(raw: bytes, dtype, rising: bool = False) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    numbers = np.ascontiguousarray(planes.T).view(dtype).reshape(-1)
    return np.cumsum(numbers, dtype=dtype) if rising else numbers
