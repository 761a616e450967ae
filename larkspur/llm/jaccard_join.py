"""Exact Jaccard join of word n-gram sets by a grouped prefix join, and its connected components.

A document's set holds the distinct hashes of its word n-grams. Documents of one set form a class, and classes are what
is joined. All n-grams have one order: by the number of classes that hold them, rarest first, then by hash. Two sets at or
above the threshold share an n-gram within their prefixes.

1. All n-grams are counted: dealt by hash, packed by batch, those of a single class dropped. The most frequent ones (a table
   of bounded size, found over all documents) need no counting and skip this, so no shard gathers a hot n-gram.
2. What is left returns to its class. A class whose prefix holds only n-grams of its own has no partner; most end here.
   The others keep the list of their shared n-grams, which is all that an intersection can hold.
3. Prefixes are posted. Classes of one size with one prefix are collapsed into a group, and only the group's first class
   posts. Postings of one n-gram meet in one shard, where pairs of groups are filtered by size and by the place of the
   n-gram. Pairs that survive are expanded to the classes of both groups and verified on their whole lists.

The links come in two rounds. The first verifies the members of each bucket against a few pivots. The second
verifies the remaining pairs, but only across components already found: a pair inside a component can't change it.
So a group of thousands of near copies costs a few comparisons for each member, while no pair of different texts that could
join two components is left out. Order and pivots decide the cost only, never the result.

Sets are told apart by 64-bit hashes, as are n-grams: two n-grams of one pair of documents collide with a chance of about
n^2 / 2^64.

Defined results: null, empty and wordless texts have an empty set, count 0 and their own id as component; equal texts
are linked; a component is named by its smallest id (null only if all its ids are null); repeated rows give repeated
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.components import connected_components
from larkspur.llm.kernels import (
    BLANKS,
    SMALL_PIECE,
    binary,
    joined,
    mix,
    packed,
    pieces,
    shard_of,
    shingles,
    split_by,
    texts_of,
    unpacked,
    word_hashes,
    words,
)
from larkspur.workspace import materialize

#: N-grams that come last in the order without being counted. Bounds a broadcast of 16 bytes each.
FREQUENT = 1 << 17
#: Documents of one batch that must hold an n-gram for the batch to report it as frequent.
REPORTED = 3


#: Classes of a bucket that the others are first compared with.
PIVOTS = 8


def sets_of(texts, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """Number of each text and the sorted distinct hashes of its word n-grams (lower-case in A-Z)."""
    for first, piece in pieces(texts, SMALL_PIECE):
        found = words(piece, BLANKS)
        runs, begin = shingles(word_hashes(piece, found), found.first, width)
        for i in range(len(piece)):
            members = np.sort(runs[begin[i] : begin[i + 1]])
            if len(members) > 1:
                fresh = np.empty(len(members), bool)
                fresh[0] = True
                np.not_equal(members[1:], members[:-1], out=fresh[1:])
                members = members[fresh]
            yield first + i, members


def _need(a, b, per_100: int):
    """Smallest intersection that links sets of sizes a and b: 100 i >= t (a + b - i)."""
    return -(-per_100 * (a + b) // (100 + per_100))


def prefix_length(n: int, per_100: int) -> int:
    """N-grams of a set of size n of which at least one is shared by any set linked with it."""
    return n - -(-per_100 * n // 100) + 1


def _identity(members: np.ndarray) -> int:
    """One number for a whole set."""
    return int(np.sum(mix(members), dtype=np.uint64).view(np.int64))


def _survey(source: DataFrame, width: int) -> DataFrame:
    """One pass over the texts: a row for each document (its set's size and identity), and a row for each n-gram that
    several documents of a batch hold (``docs`` of them)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, every = [], [], []
            for _, members in sets_of(texts_of(batch.column(1)), width):
                sizes.append(len(members))
                nodes.append(_identity(members))
                every.append(members)
            every = np.sort(np.concatenate(every)) if every else np.zeros(0, np.uint64)
            # A value that occurs REPORTED times equals the one REPORTED - 1 places on.
            some = np.unique(every[REPORTED - 1 :][every[REPORTED - 1 :] == every[: max(len(every) - REPORTED + 1, 0)]])
            n = np.searchsorted(every, some, "right") - np.searchsorted(every, some)
            m, k = len(batch), len(some)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0), pa.nulls(k, batch.column(0).type)]),
                    pa.concat_arrays([batch.column(2), pa.nulls(k, pa.int64())]),
                    pa.array(np.concatenate([sizes, np.zeros(k)]).astype(np.int64)),
                    pa.array(np.concatenate([np.array(nodes, np.int64), some.view(np.int64)])),
                    pa.array(np.concatenate([np.zeros(m, np.int64), n])),
                ],
                names=["id", "version", "n", "node", "docs"],
            )

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, version long, n long, node long, docs long")


def _frequent(survey: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of most documents, at most FREQUENT of them: sorted hashes and their rank, rarest first."""
    counted = survey.where("docs > 0").groupBy("node").agg(F.sum("docs").alias("docs"))
    top = counted.orderBy(F.desc("docs"), "node").limit(FREQUENT).toArrow()
    hashes = top["node"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], (len(hashes) - 1 - order).astype(np.int64)


#: A posted n-gram is named by 40 bits beside its shard; two of one name only cost a comparison more.
_NAME = np.uint64((1 << 40) - 1)
_POSTED = {"gram": np.uint64, "owner": np.int64, "size": np.int32, "place": np.int32, "weight": np.int64}
_PACKED = "shard int, " + ", ".join(f"{c} binary" for c in _POSTED) + ", leader binary, member binary"


def _grams(frequent, width: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All n-grams of the classes of each batch; frequent ones go to the shard of their class, with size and rank."""
        hashes, ranks = frequent.value
        for batch in batches:
            seen, grams, owner, owners, sizes, late, rank = set(), [], [], [], [], [], []
            for _, members in sets_of(texts_of(batch.column(0)), width):
                node = _identity(members)
                if not len(members) or node in seen:
                    continue
                seen.add(node)
                at = np.searchsorted(hashes, members)
                at[at == len(hashes)] = 0
                common = hashes[at] == members if len(hashes) else np.zeros(len(members), bool)
                grams.append(members[~common])
                owner.append(np.full(len(members) - common.sum(), len(owners), np.uint32))
                late.append(np.full(common.sum(), node, np.int64))
                rank.append(ranks[at[common]] | len(members) << 20)
                owners.append(node)
                sizes.append(len(members))
            if owners:
                grams, owner, late, rank = (np.concatenate(c) for c in (grams, owner, late, rank))
                yield from posted_rows(grams, owner, np.zeros(len(grams), np.uint32), np.array(owners, np.int64),
                                       np.array(sizes, np.int32), np.ones(len(owners), np.int64), late, rank, shards)

    return run


_RETURNED = {"gram": np.uint64, "node": np.int64, "size": np.int32, "docs": np.int64}


def _returned(shards: int):
    def run(table: pa.Table) -> pa.Table:
        """A shard's n-grams of more than one class, dealt by class, with the number of classes; and the frequent ones."""
        gram, owner, size, _, _ = _received(table, False)
        order = np.lexsort((owner, gram))
        gram, owner, size = gram[order], owner[order], size[order]
        keep = np.ones(len(gram), bool)
        keep[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
        gram, owner, size = gram[keep], owner[keep], size[keep]
        first, last = _buckets(gram)
        docs = np.repeat(last - first, last - first)
        shared = docs > 1
        shard = table["shard"][0].as_py()
        gram = gram | np.uint64(shard << 40)
        node, packed_rank = joined(table["leader"], np.int64), joined(table["member"], np.int64)
        rank = packed_rank & ((1 << 20) - 1)
        columns = [
            np.concatenate([gram[shared], rank.astype(np.uint64) | np.uint64(1 << 63)]),
            np.concatenate([owner[shared], node]),
            np.concatenate([size[shared], (packed_rank >> 20).astype(np.int32)]),
            np.concatenate([docs[shared], rank + (1 << 40)]),
        ]
        order = np.argsort(columns[1], kind="stable")  # a class's rows stand together and compress
        columns = [c[order] for c in columns]
        dealt = list(split_by(shard_of(mix(columns[1]), shards), shards, *columns))
        return pa.table(
            [pa.array([k for k, _ in dealt], pa.int32()),
             *(pa.array([packed(c[j]) for _, c in dealt], pa.binary()) for j in range(4))],
            names=["shard", *_RETURNED],
        )

    return run


def _lists(per_100: int):
    def run(table: pa.Table) -> pa.Table:
        """Classes that may have a partner: their shared n-grams in order, and how many of them lie in the prefix."""
        gram, node, size, docs = (
            np.concatenate([unpacked(v, kind) for v in table[name].to_pylist()]) for name, kind in _RETURNED.items()
        )
        order = np.lexsort((gram, docs, node))
        gram, node, size, docs = gram[order], node[order], size[order].astype(np.int64), docs[order]
        keep = np.ones(len(gram), bool)
        keep[1:] = (gram[1:] != gram[:-1]) | (node[1:] != node[:-1])
        gram, node, size, docs = gram[keep], node[keep], size[keep], docs[keep]
        first, last = _buckets(node)
        n = size[first] if len(first) else first
        own = n - (last - first)
        prefix = np.minimum(n - -(-per_100 * n // 100) + 1 - own, last - first)
        use = np.flatnonzero(prefix > 0)
        return pa.table(
            {
                "node": node[first[use]],
                "n": n[use],
                "own": own[use],
                "prefix": prefix[use],
                # How much of it others hold too: of near copies, most for the one they come from.
                "weight": np.add.reduceat(np.minimum(docs, 1 << 30), first)[use] if len(first) else first,
                "grams": binary([gram[first[k] : last[k]] for k in use]),
            }
        )

    return run


def _postings(per_100: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Prefixes of the groups of each batch, and the members of its groups.

        A group is the classes of a batch of one size with one prefix; its first class posts for all.
        """
        for batch in batches:
            grams, owner, place, owners, sizes, weights, groups, leaders, members = [], [], [], [], [], [], {}, [], []
            for row in batch.to_pylist():
                prefix = row["grams"][: 8 * row["prefix"]]
                leader = groups.setdefault((row["n"], prefix), row["node"])
                if leader != row["node"]:
                    leaders.append(leader)
                    members.append(row["node"])
                    continue
                grams.append(mix(np.frombuffer(prefix, np.uint64)))
                owner.append(np.full(row["prefix"], len(owners), np.uint32))
                place.append(np.arange(row["own"], row["own"] + row["prefix"], dtype=np.uint32))
                owners.append(row["node"])
                sizes.append(row["n"])
                weights.append(row["weight"])
            if owners:
                yield from posted_rows(
                    *(np.concatenate(c) for c in (grams, owner, place)), np.array(owners, np.int64),
                    np.array(sizes, np.int32), np.array(weights, np.int64), np.array(leaders, np.int64), np.array(members, np.int64), shards,
                )

    return run


_SENT = ["shard", "gram", "number", "place", "owners", "sizes", "weights", "leader", "member"]


def posted_schema() -> str:
    return ", ".join(f"{c} {'int' if c == 'shard' else 'binary'}" for c in _SENT)


def posted_rows(gram, owner, place, owners, sizes, weights, leaders, members, shards: int) -> Iterator[pa.RecordBatch]:
    """A row for each shard: its postings (n-gram, number of the owner, place), the owners they refer to with their
    sizes and weights, and the classes folded into another."""
    folded = dict(split_by(shard_of(mix(leaders), shards), shards, leaders, members))
    posted = dict(split_by(shard_of(gram, shards), shards, gram & _NAME, owner, place))
    for k in sorted(posted.keys() | folded.keys()):
        name, number, at = posted.get(k, [gram[:0], owner[:0], place[:0]])
        by_name = np.argsort(name, kind="stable")
        here, number = np.unique(number[by_name], return_inverse=True)
        row = [
            packed(name[by_name], True), packed(number.astype(np.uint32)), packed(at[by_name]),
            owners[here].tobytes(), packed(sizes[here]), packed(weights[here]), *(c.tobytes() for c in folded.get(k, [leaders[:0]] * 2)),
        ]
        columns = [pa.array([k], pa.int32()), *(pa.array([c], pa.binary()) for c in row)]
        yield pa.RecordBatch.from_arrays(columns, names=_SENT)


def _received(table: pa.Table, weighed: bool) -> tuple[np.ndarray, ...]:
    """N-gram, owner, size, place and weight of a shard's postings, without the names that occur once (most do)."""
    parts = []
    for row in table.select(_SENT[1:7]).to_pylist():
        number = unpacked(row["number"], np.uint32)
        owners, sizes = np.frombuffer(row["owners"], np.int64), unpacked(row["sizes"], np.int32)
        parts.append((unpacked(row["gram"], np.uint64, True), owners[number], sizes[number],
                      unpacked(row["place"], np.uint32).astype(np.int32),
                      unpacked(row["weights"], np.int64)[number] if weighed else number))
    gram, owner, size, place, weight = (np.concatenate(c) for c in zip(*parts, strict=True))
    del parts
    some = np.sort(gram)
    again = np.unique(some[1:][some[1:] == some[:-1]])
    at = np.searchsorted(again, gram)
    at[at == len(again)] = 0
    use = again[at] == gram if len(again) else np.zeros(len(gram), bool)
    return gram[use], owner[use], size[use], place[use], weight[use]


def _shared(table: pa.Table) -> pa.Table:
    """A shard's postings of n-grams that more than one group has, by n-gram and size."""
    gram, owner, size, place, weight = _received(table, True)
    order = np.lexsort((owner, size, gram))
    gram, owner, size, place, weight = gram[order], owner[order], size[order], place[order], weight[order]
    # The same class, posted by several batches.
    keep = np.ones(len(gram), bool)
    keep[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    weight = np.add.reduceat(weight, np.flatnonzero(keep)) if len(gram) else weight
    gram, owner, size, place = gram[keep], owner[keep], size[keep], place[keep]
    shared = np.zeros(len(gram), bool)
    shared[1:] = gram[1:] == gram[:-1]
    shared[:-1] |= shared[1:]
    folded = np.unique(np.stack([joined(table["leader"], np.int64), joined(table["member"], np.int64)]), axis=1)
    columns = [*(c[shared] for c in (gram, owner, size, place, weight)), folded[0], folded[1]]
    return pa.table(
        [table["shard"].slice(0, 1).combine_chunks(), *(binary([c]) for c in columns)],
        names=["shard", *_POSTED, "leader", "member"],
    )


def _buckets(gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(gram):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
    return first, np.concatenate([first[1:], [len(gram)]]).astype(np.int64)


def _possible(size_a, place_a, size_b, place_b, per_100: int):
    """Whether two sets that share the n-grams at these places, and none before, may be linked."""
    need = _need(size_a, size_b, per_100)
    return 1 + np.minimum(size_a - place_a - 1, size_b - place_b - 1) >= need


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    if not a:
        return np.zeros((2, 0), np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    return np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)


def _stars(per_100: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every member of a group with its leader, every group of a bucket with the bucket's next smaller pivot."""
        for batch in batches:
            for row in batch.to_pylist():
                gram, owner, size, place, weight = (np.frombuffer(row[name], kind) for name, kind in _POSTED.items())
                a, b = [np.frombuffer(row["leader"], np.int64)], [np.frombuffer(row["member"], np.int64)]
                # A pivot serves a band of sizes: one of the weightiest there; which one depends on the n-gram, so that a
                # class meets several pivots.
                band = np.floor(np.log(np.maximum(size, 1)) / np.log(1.1)).astype(np.int64)
                order = np.lexsort((owner, -weight, band, gram))
                gram, owner, size, place, band = gram[order], owner[order], size[order], place[order], band[order]
                start = np.ones(len(gram), bool)
                start[1:] = (gram[1:] != gram[:-1]) | (band[1:] != band[:-1])
                first = np.flatnonzero(start)
                n = np.diff(np.concatenate([first, [len(gram)]]))
                pivot = np.repeat(first + (gram[first] % np.uint64(PIVOTS)).astype(np.int64) % np.maximum(n, 1), n)
                use = _possible(size[pivot], place[pivot], size, place, per_100) & (owner[pivot] != owner)
                a.append(owner[pivot][use])
                b.append(owner[use])
                pairs = _pairs(a, b)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return run


#: Bits of the smallest outline, and bits for each member of a larger set.
_OUTLINE, _EACH = 512, 8
#: Pairs whose outlines are compared at a time.
_AT_ONCE = 1 << 15


def outline(members: np.ndarray) -> np.ndarray:
    """Bits that the members of a set have by their hashes; a power of two of them, several for each member."""
    n = max(_OUTLINE, 1 << (_EACH * max(len(members), 1) - 1).bit_length())
    bits = np.zeros(n, np.uint8)
    bits[mix(members) & np.uint64(n - 1)] = 1
    return np.packbits(bits, bitorder="little")


class _Outlines:
    """An exact bound of what two sets share: a bit that one of them has alone stands for a member it has alone.

    Outlines of different lengths are compared at the shorter one; the longer is folded, half onto half.
    """

    def __init__(self, bits: list[bytes]):
        self.width = np.array([len(b) for b in bits], np.int64)
        self.row = np.zeros(len(bits), np.int64)
        self.tables: dict[tuple[int, int], np.ndarray] = {}
        for w in np.unique(self.width).tolist():
            mine = np.flatnonzero(self.width == w)
            self.row[mine] = np.arange(len(mine))
            self.tables[w, w] = np.frombuffer(b"".join(bits[k] for k in mine), np.uint64).reshape(len(mine), -1)

    def _folded(self, width: int, to: int) -> np.ndarray:
        if (width, to) not in self.tables:
            wide = self._folded(width, 2 * to)
            half = wide.shape[1] // 2
            self.tables[width, to] = wide[:, :half] | wide[:, half:]
        return self.tables[width, to]

    def possible(self, a, b, size_a, size_b, per_100: int) -> np.ndarray:
        """Whether sets number ``a`` and ``b``, of these sizes, may share enough to be linked."""
        out = np.zeros(len(a), bool)
        for first in range(0, len(a), _AT_ONCE):
            x, y = a[first : first + _AT_ONCE], b[first : first + _AT_ONCE]
            widths = self.width[x] << 32 | self.width[y]
            for both in np.unique(widths).tolist():
                at = np.flatnonzero(widths == both)
                low = min(both >> 32, both & 0xFFFFFFFF)
                left = self._folded(both >> 32, low)[self.row[x[at]]]
                right = self._folded(both & 0xFFFFFFFF, low)[self.row[y[at]]]
                n, m = size_a[first + at], size_b[first + at]
                shared = np.minimum(
                    n - np.bitwise_count(left & ~right).sum(axis=1, dtype=np.int64),
                    m - np.bitwise_count(right & ~left).sum(axis=1, dtype=np.int64),
                )
                out[first + at] = shared >= _need(n, m, per_100)
        return out


def _crossings(per_100: int, pivots_only: bool):
    """All pairs of classes in different components that may be linked; or only those of each class outside a bucket's
    commonest component with a pivot inside it, other ones than those compared first. Where the labels come with the
    outlines of the sets, pairs that these rule out are left out."""

    def run(posted: pa.Table, labels: pa.Table) -> pa.Table:
        """Pairs of classes in different components that their groups' sizes and places leave possible."""
        if not posted.num_rows:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        gram, owner, size, place, weight = (joined(posted[name], kind) for name, kind in _POSTED.items())
        leader, node, label = (labels[name].to_numpy() for name in ("owner", "node", "label"))
        order = np.argsort(leader, kind="stable")
        leader, node, label = leader[order], node[order], label[order]
        outlines = None
        if "outline" in labels.column_names:
            outlines = _Outlines(labels["outline"].take(pa.array(order)).to_pylist())
        low, high = np.searchsorted(leader, owner), np.searchsorted(leader, owner, "right")
        a, b, held = [], [], 0
        for first, last in zip(*_buckets(gram), strict=True):
            # Every class of every group of the bucket.
            n = high[first:last] - low[first:last]
            at = np.repeat(np.arange(first, last), n)
            which = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + low[at]
            kinds, kind = np.unique(label[which], return_inverse=True)
            if len(kinds) == 1:
                continue
            # All but the commonest component against everything, or against one of its classes.
            common = np.argmax(np.bincount(kind))
            odd = np.flatnonzero(kind != common)
            every = np.arange(len(at))
            if pivots_only:
                inside = np.flatnonzero(kind == common)
                inside = inside[np.argsort(-weight[at[inside]], kind="stable")]
                every = inside[[(PIVOTS + int(gram[first] % np.uint64(2 * PIVOTS))) % len(inside)]]
            step = max(1, (1 << 20) // len(every))
            for k in range(0, len(odd), step):
                x, y = odd[k : k + step][:, None], every[None, :]
                ok = (kind[x] != kind[y]) & ((kind[y] == common) | (x < y))
                ok &= _possible(size[at[x]], place[at[x]], size[at[y]], place[at[y]], per_100)
                i, j = np.nonzero(ok)
                x, y = x[i, 0], y[0, j]
                if outlines is not None:
                    may = outlines.possible(which[x], which[y], size[at[x]].astype(np.int64), size[at[y]].astype(np.int64), per_100)
                    x, y = x[may], y[may]
                a.append(node[which[x]])
                b.append(node[which[y]])
                held += len(x)
                if held > 1 << 21:
                    done = _pairs(a, b)
                    a, b, held = [done[0]], [done[1]], 0
        pairs = _pairs(a, b)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return run


def settled(
    near: DataFrame,
    posted: DataFrame,
    places: DataFrame,
    members: DataFrame,
    sets: DataFrame,
    per_100: int,
    kind=np.uint64,
    outlines: DataFrame | None = None,
) -> DataFrame:
    """Components of all links, given those found among the first pairs.

    ``places`` says in which shards a group is posted, ``members`` which classes it stands for. First, classes outside
    their buckets' commonest component are compared with pivots inside it; what is then still apart is compared in full.
    With ``outlines`` (node, outline) each shard drops the pairs that cannot reach the threshold, before any set is joined.
    """
    labels = materialize(connected_components(near), "components")
    for again in (True, False):
        labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("component", "node"))
        labelled = materialize(labelled.select("owner", "node", "label"), "labels")
        here = places.join(labelled, "owner")
        here = (here if outlines is None else here.join(outlines, "node")).groupBy("shard")
        rest = posted.groupBy("shard").cogroup(here).applyInArrow(_crossings(per_100, again), "a long, b long")
        if not again:
            x, y = labelled.alias("x"), labelled.alias("y")
            inside = x.join(y, F.expr("x.owner = y.owner AND x.node < y.node AND x.label <> y.label"))
            rest = rest.union(inside.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
        rest = materialize(rest.distinct(), "rest")
        # New links join components, which are few beside the classes in them.
        found = agreed(rest, sets, per_100, kind)
        named = labelled.select("node", "label").distinct()
        found = found.join(named.withColumnsRenamed({"node": "a", "label": "x"}), "a")
        found = found.join(named.withColumnsRenamed({"node": "b", "label": "y"}), "b")
        joined_up = connected_components(found.select("x", "y"), "x", "y")
        joined_up = joined_up.withColumnsRenamed({"node": "label", "component": "top"})
        whole = named.union(labels.select("node", F.col("component").alias("label"))).distinct()
        labels = whole.join(joined_up, "label", "left").select("node", F.coalesce("top", "label").alias("component"))
        labels = materialize(labels, "components")
    return labels


def agreed(pairs: DataFrame, sets: DataFrame, per_100: int, kind=np.uint64) -> DataFrame:
    """The pairs (a, b) that reach the threshold: sets of size n whose common n-grams are all in ``grams``."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("grams").alias("grams_a"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("grams").alias("grams_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            rows = (batch.column(c).to_pylist() for c in ("n_a", "grams_a", "n_b", "grams_b"))
            for n, x, m, y in zip(*rows, strict=True):
                both = np.sort(np.concatenate([np.frombuffer(x, kind), np.frombuffer(y, kind)]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * shared >= per_100 * (n + m - shared))
            at = pa.array(keep, pa.bool_())
            columns = [batch.column("a").filter(at), batch.column("b").filter(at)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "grams_a", "n_b", "grams_b")
    return both.mapInArrow(run, "a long, b long")


def _linked(source: DataFrame, width: int, per_100: int) -> tuple[DataFrame, DataFrame]:
    """Per row of (id, text, version): id, version, size n and identity of its set; and per class its component."""
    spark = source.sparkSession
    # Two shards for each task of a shuffle: a group is what a task holds at once.
    shards = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    survey = materialize(_survey(source, width), "survey")
    frequent = spark.sparkContext.broadcast(_frequent(survey))
    sent = source.select("text").mapInArrow(_grams(frequent, width, shards), posted_schema())
    back = sent.groupBy("shard").applyInArrow(
        _returned(shards), "shard int, " + ", ".join(f"{c} binary" for c in _RETURNED)
    )
    lists = back.groupBy("shard").applyInArrow(_lists(per_100), "node long, n long, own long, prefix long, weight long, grams binary")
    lists = materialize(lists, "lists")
    # Prefixes are few beside all n-grams; in fewer shards, fewer pairs are met twice.
    sent = lists.mapInArrow(_postings(per_100, max(1, shards // 16)), posted_schema())
    posted = materialize(sent.groupBy("shard").applyInArrow(_shared, _PACKED), "posted")
    stars = materialize(posted.mapInArrow(_stars(per_100), "a long, b long").distinct(), "stars")
    near = materialize(agreed(stars, lists, per_100), "near")
    # Where each group is posted, and the classes it stands for.
    places = materialize(posted.mapInArrow(_places, "shard int, owner long").distinct(), "places")
    folds = posted.mapInArrow(_folds, "owner long, node long").distinct()
    alone = places.select("owner").union(folds.select("owner")).distinct().select("owner", F.col("owner").alias("node"))
    members = materialize(alone.union(folds), "members")
    found = settled(near, posted, places, members, lists, per_100)
    return survey.where("docs = 0").select("id", "version", "n", "node"), found


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    version = F.xxhash64(F.coalesce(text, F.lit("")))
    return docs.select(F.col(id_col).alias("id"), text.alias("text"), version.alias("version"))


def jaccard_components(
    docs: DataFrame, width: int = 5, per_100: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: ``id_col``, n_shingles and component_id, where sets with 100 * intersection >= per_100 * union link."""
    documents, found = _linked(_source(docs, id_col, text_col), width, per_100)
    classes = documents.where("n > 0").groupBy("node").agg(F.min("id").alias("id"))
    whole = classes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = whole.groupBy("component").agg(F.min("id").alias("component_id"))
    whole = whole.join(named, "component").select("node", "component_id")
    result = documents.join(whole, "node", "left")
    return result.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(
    docs: DataFrame, width: int = 5, per_100: int = 75, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component, with all its columns: the smallest id (a null one only if all are), then the smallest
    hash of the text, then any of equal rows. Rows without words all stay. Ids must be whole numbers."""
    documents, found = _linked(_source(docs, id_col, text_col), width, per_100)
    last = F.lit(int(np.iinfo(np.int64).max))
    place = F.struct(F.coalesce("id", last).alias("key"), "version")
    grouped = documents.where("n > 0").join(found, "node", "left")
    grouped = grouped.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min(place).alias("first"))
    chosen = grouped.select("first.key", "first.version").distinct().withColumn("chosen", F.lit(True))

    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
        F.coalesce(F.col(id_col).cast("long"), last).alias("key"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"),
        F.coalesce(F.trim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit("")).eqNullSafe("").alias("blank"),
    )
    once = F.row_number().over(Window.partitionBy("key", "version").orderBy("key"))
    marked = rows.join(chosen, ["key", "version"], "left").withColumn("once", once)
    return marked.where(F.col("blank") | (F.col("chosen") & (F.col("once") == 1))).select("row.*")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups posted in each shard."""
    for batch in batches:
        for shard, owner in zip(batch.column("shard").to_pylist(), batch.column("owner").to_pylist(), strict=True):
            owner = np.unique(np.frombuffer(owner, np.int64))
            columns = [pa.array(np.full(len(owner), shard, np.int32)), pa.array(owner)]
            yield pa.RecordBatch.from_arrays(columns, names=["shard", "owner"])


def _folds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes folded into each group."""
    for batch in batches:
        columns = [pa.array(joined(batch.column(name), np.int64)) for name in ("leader", "member")]
        yield pa.RecordBatch.from_arrays(columns, names=["owner", "node"])
