"""Conversations brought back to a legal order of roles by the cheapest edits.

A legal conversation is empty, or an optional system turn and then user and assistant turns in pairs. Rows and the state
of that rule span a lattice: keeping, re-roling or deleting a row goes on to the next row, inserting an empty turn changes
the state alone. The cheapest path is found by Dijkstra's search from both ends. Forward and reverse heaps meet; all
crossings of the least cost are finished, and of these the one with the least concatenated audit is taken. Labels carry
their part of the audit: two cheapest ways to one node are never one the beginning of the other, so the least part of each
half belongs to the least whole.

Spark sorts rows by conversation and turn over ranges, so one conversation may be spread over many tasks. A task
searches conversations that lie within it as a whole. One that touches the end of a range, or has more than a piece of rows,
is cut into pieces; each piece is searched for every state it may be entered and left in, a fold over these few
numbers picks the states, and its text passes through as a stream. Inserts at a cut belong to the piece that follows.

Defined results: null conversation ids are one conversation; null roles and texts are one space; null turns come first;
rows of one turn are taken by role and text. A conversation all of whose rows are gone has zeros, an empty audit and the digest of
an empty string. An empty table has no rows. Other columns are ignored. Rows that are equal in everything go to one task.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from larkspur.workspace import materialize

#: Rows and characters of a piece of a conversation that a task searches at once.
PIECE_ROWS = 2048
PIECE_CHARS = 8 << 20

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a turn of each role, and what completes a conversation that stops in a state.
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
BEFORE = {q: [(p, role) for (p, role), after in AFTER.items() if after == q] for q in range(4)}
COMPLETED = {START: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}

_BLANK = " \t\n\x0b\f\r"


@dataclass
class Turn:
    """What the search needs of a row: initial of its role, whether it has to go, whether it is truncated."""

    initial: str
    gone: bool
    truncated: bool


def _forward(turns: list[Turn], node: tuple[int, int], last: bool) -> Iterator[tuple[tuple[int, int], int, str]]:
    i, q = node
    if i < len(turns) or last:
        for role in "ua":
            if (q, role) in AFTER:
                yield (i, AFTER[q, role]), INSERT, "I"
    if i < len(turns):
        turn = turns[i]
        yield (i + 1, q), DELETE, "D"
        if not turn.gone:
            if (q, turn.initial) in AFTER:
                yield (i + 1, AFTER[q, turn.initial]), KEEP + TRUNCATED * turn.truncated, "K"
            for role in "ua":
                if (q, role) in AFTER:
                    yield (i + 1, AFTER[q, role]), REROLE + TRUNCATED * turn.truncated, "R"


def _backward(turns: list[Turn], node: tuple[int, int], last: bool) -> Iterator[tuple[tuple[int, int], int, str]]:
    i, q = node
    if i < len(turns) or last:
        for p, role in BEFORE[q]:
            if role in ROLES:
                yield (i, p), INSERT, "I"
    if i:
        turn = turns[i - 1]
        yield (i - 1, q), DELETE, "D"
        if not turn.gone:
            for p, role in BEFORE[q]:
                if role == turn.initial:
                    yield (i - 1, p), KEEP + TRUNCATED * turn.truncated, "K"
                if role in ROLES:
                    yield (i - 1, p), REROLE + TRUNCATED * turn.truncated, "R"


def cheapest(turns: list[Turn], entry: int = START, exits: tuple[int, ...] = (START, ASSISTANT), last: bool = True):
    """Cost and least audit of the cheapest edits from the state before the first row to one of ``exits`` after the last, or
    None. ``last`` allows inserts after the last row."""
    ahead, back = {(0, entry): (0, "")}, {(len(turns), q): (0, "") for q in exits}
    # At equal cost rows are settled in order: the only edges without cost lead to the next row.
    forward, reverse = [(0, 0, "", entry)], [(0, -len(turns), "", q) for q in exits]
    heapq.heapify(reverse)
    from_start: dict[tuple[int, int], tuple[int, str]] = {}
    to_end: dict[tuple[int, int], tuple[int, str]] = {}
    best = None

    def crossing(cost: int, audit: str) -> None:
        nonlocal best
        if best is None or (cost, audit) < best:
            best = (cost, audit)

    while forward or reverse:
        low, high = forward[0][0] if forward else 0, reverse[0][0] if reverse else 0
        if best is not None and low + high > best[0]:
            break
        if forward and (not reverse or low <= high):
            cost, i, audit, q = heapq.heappop(forward)
            if (i, q) in from_start:
                continue
            from_start[i, q] = (cost, audit)
            if (i, q) in to_end:
                crossing(cost + to_end[i, q][0], audit + to_end[i, q][1])
            for node, weight, letter in _forward(turns, (i, q), last):
                label = (cost + weight, audit + letter)
                if node in to_end:
                    crossing(label[0] + to_end[node][0], label[1] + to_end[node][1])
                if node not in ahead or label < ahead[node]:
                    ahead[node] = label
                    heapq.heappush(forward, (label[0], node[0], label[1], node[1]))
        else:
            cost, i, audit, q = heapq.heappop(reverse)
            if (-i, q) in to_end:
                continue
            to_end[-i, q] = (cost, audit)
            if (-i, q) in from_start:
                crossing(cost + from_start[-i, q][0], from_start[-i, q][1] + audit)
            for node, weight, letter in _backward(turns, (-i, q), last):
                label = (cost + weight, letter + audit)
                if node in from_start:
                    crossing(label[0] + from_start[node][0], from_start[node][1] + label[1])
                if node not in back or label < back[node]:
                    back[node] = label
                    heapq.heappush(reverse, (label[0], -node[0], label[1], node[1]))
    return best


def edited(audit: str, rows: list[tuple[str, str]], state: int = START) -> Iterator[str]:
    """``role:text`` of the rows after the edits of an audit; the state says which role an edit gives."""
    at = 0
    for letter in audit:
        role, text = ("", "") if letter == "I" else rows[at]
        at += letter != "I"
        if letter == "D":
            continue
        if letter in "IR":
            role = "assistant" if state == USER else "user"
        state = AFTER[state, role[:1]]
        yield f"{role}:{text}"


@dataclass
class Piece:
    """Consecutive rows of one conversation."""

    rows: list[tuple[str, str]] = field(default_factory=list)
    turns: list[Turn] = field(default_factory=list)
    numbers: list[int] = field(default_factory=list)
    chars: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    distinct: int = 0

    def add(self, number: int | None, role: str, text: str, seen: bool) -> None:
        bare = text.strip(_BLANK)
        blank = not bare
        duplicate = not blank and seen
        truncated = not blank and not duplicate and bare[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        turn = Turn(role[:1], blank or duplicate, truncated)
        if self.turns:
            self.illegal += self.turns[-1].initial + turn.initial not in LEGAL
        if number is not None:
            self.distinct += not self.numbers or self.numbers[-1] != number
            self.numbers = [self.numbers[0] if self.numbers else number, number]
        self.rows.append((role, text))
        self.turns.append(turn)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.rows) >= PIECE_ROWS or self.chars >= PIECE_CHARS


_STATS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_PIECE = (
    "part int, nth long, whole boolean, first_turn long, last_turn long, distinct long, blank long, duplicate long, "
    "truncated long, illegal long, first_initial string, last_initial string, n_rows long, cost long, audit string, "
    "repaired_sha256 string, repaired string, costs array<long>, ranks array<int>, audits array<string>, "
    "roles array<string>, texts array<string>"
)


def _described(piece: Piece, whole: bool, texts: bool) -> dict:
    found = {
        "whole": whole, "first_turn": piece.numbers[0] if piece.numbers else None,
        "last_turn": piece.numbers[-1] if piece.numbers else None, "distinct": piece.distinct, "blank": piece.blank,
        "duplicate": piece.duplicate, "truncated": piece.truncated, "illegal": piece.illegal,
        "first_initial": piece.turns[0].initial if piece.turns else None,
        "last_initial": piece.turns[-1].initial if piece.turns else None, "n_rows": len(piece.rows),
    }
    if whole:
        cost, audit = cheapest(piece.turns)
        repaired = "\n".join(edited(audit, piece.rows))
        digest = hashlib.sha256(repaired.encode()).hexdigest()
        return {**found, "cost": cost, "audit": audit, "repaired_sha256": digest, "repaired": repaired if texts else None}
    ways = [[cheapest(piece.turns, p, (q,), last=False) for q in range(4)] for p in range(4)]
    costs, ranks, audits = [], [], []
    for row in ways:
        order = sorted(w[1] for w in row if w)
        for w in row:
            costs.append(w[0] if w else None)
            ranks.append(order.index(w[1]) if w else None)
            audits.append(w[1] if w else None)
    roles, words = zip(*piece.rows, strict=True) if piece.rows else ((), ())
    return {**found, "costs": costs, "ranks": ranks, "audits": audits, "roles": list(roles), "texts": list(words)}


def _searched(batches: Iterator[pa.RecordBatch], schema: pa.Schema, texts: bool) -> Iterator[pa.RecordBatch]:
    """Pieces of the conversations of one sorted range; whole ones are searched to the end."""
    part, nth, out, held = TaskContext.get().partitionId(), 0, [], 0
    id, piece, cut = None, None, True

    def close(whole: bool) -> None:
        nonlocal nth, held
        out.append({"conv_id": id, "part": part, "nth": nth, **_described(piece, whole, texts)})
        nth += 1
        held += piece.chars if texts or not whole else 100

    for batch in batches:
        for own, present, number, role, text, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if piece is None:
                id, piece, cut = own, Piece(), True  # may have begun in the range before
            elif own != id:
                close(whole=not cut)
                id, piece, cut = own, Piece(), False
            elif piece.full():
                close(whole=False)
                piece, cut = Piece(), True
            if present:
                piece.add(number, role, text, seen)
            if len(out) >= 5_000 or held >= PIECE_CHARS:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, held = [], 0
    if piece is not None:
        close(whole=False)  # may go on in the next range
    if out:
        yield pa.RecordBatch.from_pylist(out, schema)


def _folded(table: pa.Table, schema: pa.Schema) -> pa.Table:
    """The states in which the pieces of one conversation are entered and left, and its figures."""
    pieces = sorted(table.to_pylist(), key=lambda r: (r["part"], r["nth"]))
    closing = [INSERT * COMPLETED[q] for q in range(4)]
    left = [closing]
    for r in reversed(pieces):
        ways = [r["costs"][4 * p : 4 * p + 4] for p in range(4)]
        left.append([min((c + n for c, n in zip(w, left[-1], strict=True) if None not in (c, n)), default=None) for w in ways])
    left.reverse()
    numbers = [n for r in pieces for n in (r["first_turn"], r["last_turn"]) if n is not None]
    distinct, illegal, last_turn, last_initial = 0, 0, None, None
    for r in pieces:
        distinct += r["distinct"] - (r["first_turn"] is not None and r["first_turn"] == last_turn)
        last_turn = r["last_turn"] if r["last_turn"] is not None else last_turn
        if r["n_rows"]:
            illegal += r["illegal"] + (last_initial is not None and last_initial + r["first_initial"] not in LEGAL)
            last_initial = r["last_initial"]
    stats = {
        "gaps": max(numbers) - min(numbers) + 1 - distinct if numbers else 0, "illegal": illegal, "cost": left[0][START],
        **{k: sum(r[k] for r in pieces) for k in ("blank", "duplicate", "truncated")},
    }
    state, chosen = START, []
    for k, r in enumerate(pieces):
        ways = [
            (r["ranks"][4 * state + q], q) for q in range(4)
            if r["costs"][4 * state + q] is not None and left[k + 1][q] is not None
            and r["costs"][4 * state + q] + left[k + 1][q] == left[k][state]
        ]
        after = min(ways)[1]
        chosen.append({"part": r["part"], "nth": r["nth"], "entry": state, "leave": after, **stats})
        state = after
    chosen[-1]["completed"] = COMPLETED[state]
    return pa.Table.from_pylist(chosen, schema)


def _streamed(batches: Iterator[pa.RecordBatch], schema: pa.Schema, texts: bool) -> Iterator[pa.RecordBatch]:
    """Audit and digest of conversations whose pieces come in order."""
    open_, digest, audit, parts, first = None, hashlib.sha256(), [], [], True
    for batch in batches:
        for k in range(batch.num_rows):
            r = batch.slice(k, 1).to_pylist()[0]
            if open_ is None:
                open_, digest, audit, parts, first = r, hashlib.sha256(), [], [], True
            own = r["audits"][4 * r["entry"] + r["leave"]]
            if r["completed"] is not None:
                own += "I" * r["completed"]
            for message in edited(own, list(zip(r["roles"], r["texts"], strict=True)), r["entry"]):
                digest.update((message if first else "\n" + message).encode())
                first = False
                if texts:
                    parts.append(message)
            audit.append(own)
            if r["completed"] is not None:
                done = {**{f.name: r.get(f.name) for f in schema}, "audit": "".join(audit)}
                done |= {"repaired_sha256": digest.hexdigest(), "repaired": "\n".join(parts) if texts else None}
                yield pa.RecordBatch.from_pylist([done], schema)
                open_ = None


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with faults planted by the CRC-32 of ``conv_id:turn``; rows that are dropped stay with ``present`` false."""
    spelled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = F.crc32(F.concat(spelled[0], F.lit(":"), spelled[1]).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(spelled[3], "[.!?]", "")).otherwise(spelled[3])
    copies = F.when(fault == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(fault != 0))
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(spelled[2]).alias("role"), text.alias("text"),
        F.explode(copies).alias("present"),
    )


def repair(rows: DataFrame, present: Column | None = None, texts: bool = False) -> DataFrame:
    """Faults, cheapest edits and the digest of the repaired text of every ``conv_id``; ``texts`` adds the text itself.

    ``present`` says which rows count; the others only keep their conversation in the result.
    """
    spark = rows.sparkSession
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(
        "conv_id",
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    # A row is a duplicate unless it is the first of its role and text; rows that are blank or gone are not asked.
    asked = F.col("present") & (F.btrim("text", F.lit(_BLANK)) != "")
    alike = Window.partitionBy("conv_id", "role", "_digest", "_spread").orderBy(F.col("turn").asc_nulls_first())
    rows = rows.withColumns({
        "_digest": F.when(asked, F.unhex(F.sha2("text", 256))),
        "_spread": F.when(~asked, F.xxhash64("turn", "text") % 1024),
    })
    rows = rows.withColumn("seen", F.when(asked, F.row_number().over(alike) > 1).otherwise(False))
    gone = ~F.col("present")
    turn = F.col("turn").asc_nulls_first()
    dealt = rows.repartitionByRange(
        shares, F.col("conv_id").asc_nulls_first(), gone, turn, F.substring("role", 1, 32), F.substring("text", 1, 32)
    )
    ordered = dealt.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), gone, turn, "role", "text")
    ordered = ordered.select("conv_id", "present", "turn", "role", "text", "seen")

    kind = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}"
    arrow = {
        name: (types, to_arrow_schema(spark.createDataFrame([], types).schema))
        for name, types in {
            "pieces": f"{kind}, {_PIECE}",
            "chosen": f"part int, nth long, entry int, leave int, completed int, {_STATS}",
            "result": f"{kind}, {_STATS}, audit string, repaired_sha256 string, repaired string",
        }.items()
    }
    types, schema = arrow["pieces"]
    found = materialize(ordered.mapInArrow(lambda b: _searched(b, schema, texts), types), "pieces")
    gaps = F.when(F.col("distinct") > 0, F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct")).otherwise(0)
    columns = [f.name for f in arrow["result"][1]]
    whole = found.where("whole").withColumn("gaps", gaps.cast("long")).select(columns)

    cut = found.where(~F.col("whole"))
    types_c, schema_c = arrow["chosen"]
    numbers = cut.select(
        "conv_id", "part", "nth", "first_turn", "last_turn", "distinct", "blank", "duplicate", "truncated", "illegal",
        "first_initial", "last_initial", "n_rows", "costs", "ranks",
    )
    chosen = numbers.groupBy("conv_id").applyInArrow(lambda t: _folded(t, schema_c), types_c)
    ways = cut.select("conv_id", "part", "nth", "audits", "roles", "texts").join(chosen, ["part", "nth"])
    types_r, schema_r = arrow["result"]
    together = ways.repartition("conv_id").sortWithinPartitions("conv_id", "part", "nth")
    rest = together.mapInArrow(lambda b: _streamed(b, schema_r, texts), types_r)
    result = whole.unionByName(rest)
    return result if texts else result.drop("repaired")
