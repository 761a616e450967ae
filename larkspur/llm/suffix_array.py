"""Suffix order of a byte string by induced sorting, on whole arrays: one step for each character, not for each suffix.

The order is exact for the first ``depth`` bytes of every suffix, which is what matching strings of that length needs.
"""

from __future__ import annotations

import numpy as np

from larkspur.llm.kernels import mix, powers


def classify(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are smaller than the next one, and the places of the leftmost of each run of these."""
    n = len(text)
    rising = np.zeros(n, bool)
    rising[-1] = True  # the end mark
    change = np.flatnonzero(text[1:] != text[:-1])
    # A run of one character goes the way of the first change after it.
    after = np.searchsorted(change, np.arange(n - 1))
    rising[:-1] = text[change[after]] < text[change[after] + 1]
    left = np.flatnonzero(rising[1:] & ~rising[:-1]) + 1
    return rising, left


def _scatter(order, at, text, place, step):
    """Append places to the buckets of their characters, in turn; ``step`` is -1 where buckets fill from their ends."""
    kind = text[place]
    by = np.argsort(kind, kind="stable")
    kind, place = kind[by], place[by]
    first = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1]]))
    n = np.diff(np.concatenate([first, [len(kind)]]))
    offset = np.arange(len(kind)) - np.repeat(first, n)
    order[np.repeat(at[kind[first]], n) + step * offset] = place
    at[kind[first]] += step * n


def induce(text: np.ndarray, rising: np.ndarray, left: np.ndarray, size: int) -> np.ndarray:
    """The order of all suffixes that follows from the order of the leftmost-smaller ones (``left``)."""
    n = len(text)
    counts = np.bincount(text, minlength=size)
    end = np.cumsum(counts)
    begin = end - counts
    order = np.full(n, -1, np.int32)
    # Leftmost-smaller suffixes at the ends of their buckets, in their order.
    at = end - 1
    _scatter(order, at, text, left[::-1], -1)
    seeds = at + 1
    # Falling suffixes, smallest bucket first: each follows from the suffix one to its right.
    at = begin.copy()
    for c in np.flatnonzero(counts):
        others, done = [], begin[c]
        while True:
            front = order[done : at[c]] if done < at[c] else None
            if front is None:
                break
            done = at[c]
            before = front[front > 0] - 1
            before = before[~rising[before]]
            kind = text[before]
            same = before[kind == c]
            order[done : done + len(same)] = same
            at[c] += len(same)
            others.append(before[kind != c])
        front = order[seeds[c] : end[c]]
        before = front[front > 0] - 1
        others.append(before[~rising[before]])
        others = np.concatenate(others)
        if len(others):
            _scatter(order, at, text, others, 1)
    # Rising suffixes, largest bucket first; the seeds are placed anew.
    falling = at
    at = end - 1
    for c in np.flatnonzero(counts)[::-1]:
        others, done = [], end[c] - 1
        while done > at[c]:
            front = order[at[c] + 1 : done + 1][::-1]
            done = at[c]
            before = front[front > 0] - 1
            before = before[rising[before]]
            kind = text[before]
            same = before[kind == c]
            order[done - len(same) + 1 : done + 1] = same[::-1]
            at[c] -= len(same)
            others.append(before[kind != c])
        front = order[begin[c] : falling[c]][::-1]
        before = front[front > 0] - 1
        before = before[rising[before]]
        others.append(before[text[before] != c])
        others = np.concatenate(others)
        if len(others):
            _scatter(order, at, text, others, -1)
    order[0] = n - 1
    return order


def _reduced_order(names: np.ndarray, rounds: int) -> np.ndarray:
    """Order of the suffixes of a string of names by their first 2^rounds names: ranks of pairs, doubled each round.

    Its alphabet is as large as the string, so it is not cut into buckets again.
    """
    n, rank, width = len(names), names.astype(np.int64), 1
    open_ = np.arange(n)
    for _ in range(rounds):
        # Only suffixes that share their rank with another are looked at again.
        sizes = np.bincount(rank, minlength=n + 1)
        open_ = open_[sizes[rank[open_]] > 1]
        if not len(open_):
            break
        later = np.where(open_ + width < n, rank[np.minimum(open_ + width, n - 1)] + 1, 0)
        by = np.lexsort((later, rank[open_]))
        head, later = rank[open_][by], later[by]
        # A rank is the number of suffixes before its group; within a group it grows by those before.
        start = np.concatenate([[True], head[1:] != head[:-1]])
        fresh = start | np.concatenate([[True], later[1:] != later[:-1]])
        group = np.maximum.accumulate(np.where(start, np.arange(len(by)), 0))
        place = np.maximum.accumulate(np.where(fresh, np.arange(len(by)), 0))
        rank = rank.copy()
        rank[open_[by]] = head + place - group
        width *= 2
    return np.argsort(rank, kind="stable")


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes in order of their first ``depth`` characters at least.

    ``text`` holds small whole numbers; its last one must be 0 and the only 0.
    """
    size = int(text.max()) + 1
    text = text.astype(np.uint16)
    if len(text) == 1:
        return np.zeros(1, np.int32)
    rising, left = classify(text)
    # Substrings from one leftmost-smaller place to the next, sorted by one induction and named.
    order = induce(text, rising, left, size)
    marked = np.zeros(len(text), bool)
    marked[left] = True
    sorted_left = order[marked[order]]
    stop = np.empty(len(text), np.int64)
    stop[left] = np.concatenate([left[1:], [len(text) - 1]]) + 1
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(text.astype(np.uint64) + np.uint64(1)) * powers(len(text)))])
    a, b = sorted_left, stop[sorted_left]
    content = (sums[b] - sums[a]) * powers(len(text), True)[a]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (content[1:] != content[:-1]) | ((b - a)[1:] != (b - a)[:-1])
    # A name is the number of substrings that are smaller.
    names = np.empty(len(text), np.int64)
    names[a] = np.maximum.accumulate(np.where(fresh, np.arange(len(a)), 0))
    # A name covers two characters at least, so this many doublings cover the depth.
    rounds = int(np.ceil(np.log2(max(depth, 2)))) if not fresh.all() else 0
    return induce(text, rising, left[_reduced_order(names[left], rounds)], size)


def token_order(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Places of all suffixes of a string of whole numbers, in order of their first ``depth`` tokens at least."""
    ranks = np.searchsorted(np.sort(tokens), tokens)
    return _reduced_order(ranks, int(np.ceil(np.log2(max(depth, 2)))))


def common_prefixes_reach(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the ``length`` bytes from each place of ``a`` equal those from the place of ``b`` beside it.

    Bytes are compared eight at a time; places must have ``length`` bytes after them (eight at least).
    """
    if length < 8:
        raise ValueError("strings of at least 8 bytes")
    words = np.zeros(len(data), np.uint64)
    n = len(data) - 7
    for k in range(8):
        words[:n] |= data[k : k + n].astype(np.uint64) << np.uint64(8 * k)
    same = np.ones(len(a), bool)
    left = np.arange(len(a))
    for offset in [*range(0, length - 7, 8), length - 8]:
        equal = words[a[left] + offset] == words[b[left] + offset]
        same[left[~equal]] = False
        left = left[equal]
    return same
