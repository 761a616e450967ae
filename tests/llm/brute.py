"""Slow and plain versions of the operators, on Python lists of (id, text)."""

import hashlib
import re
from collections import defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(UPPER)


def blank_words(text):
    return re.findall("[^\x20\x09-\x0d]+", lower(text))


def mark_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def contamination(texts, items, width=10):
    windows = defaultdict(set)
    for item, text in items:
        words = mark_words(text)
        for i in range(max(len(words) - width + 1, 1) if words else 0):
            windows[tuple(words[i : i + width])].add(str(item))
    out = []
    for text in texts:
        words, hit, met = mark_words(text), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                found = windows.get(tuple(words[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    met |= found
        digest = hashlib.sha256(",".join(sorted(met)).encode()).hexdigest()
        out.append((len(words), len(hit), len(met), digest, bool(hit)))
    return out


def repeats(rows, length):
    """Per row: bytes, removed, spans and digest of what is kept; rows as (id, text)."""
    first = {}
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    raw = [(t or "").encode() for _, t in rows]
    for k in order:
        for i in range(len(raw[k]) - length + 1):
            place = (rows[k][0] is not None, rows[k][0] or 0, i)
            window = raw[k][i : i + length]
            first[window] = min(first.get(window, place), place)
    out = []
    for k, (key, _) in enumerate(rows):
        gone = bytearray(len(raw[k]))
        for i in range(len(raw[k]) - length + 1):
            if first[raw[k][i : i + length]] < (key is not None, key or 0, i):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw[k], gone, strict=True) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(raw[k]), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, width=5):
    words = blank_words(text)
    return {tuple(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))} if words else set()


def components(rows, per_100=75):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= per_100 * (len(sets[a]) + len(sets[b]) - shared):
                parent[root(a)] = root(b)
    ids = defaultdict(list)
    for k, (key, _) in enumerate(rows):
        ids[root(k)].append(key)
    least = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return [(len(sets[k]), least[root(k)]) for k in range(len(rows))]


def top_k(vectors, queries, k, scale=1024):
    import math

    whole = {i: [math.floor(scale * float(x)) for x in v] for i, v in vectors}
    out = []
    for q in queries:
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return out
