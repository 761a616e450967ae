"""Conversation repair: the search against plain dynamic programming over all edits, pieces against whole conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import ready  # noqa: F401
from pyspark.sql import functions as F

from larkspur.llm import conversation_repair as cr
from larkspur.llm.conversation_repair import Turn, cheapest, damaged, edited, repair

FOLDER = "/root/testdata/sf0.001"
RULE = re.compile(r"(s?(ua)+)?\Z")
BLANK = " \t\n\x0b\f\r"


def all_edits(turns):
    """Cost and audit of the best of all edits, by trying each of them with up to two inserts in each gap."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    choices = []
    for t in turns:
        own = [("D", "", 3)]
        if not t.gone:
            own += [("K", t.initial or "?", int(t.truncated)), ("R", "u", 2 + t.truncated), ("R", "a", 2 + t.truncated)]
        choices.append([("I" * len(g) + letter, g + role, 2 * len(g) + cost) for g in gaps for letter, role, cost in own])
        choices[-1] += [("D" + "I" * len(g), g, 3 + 2 * len(g)) for g in gaps[1:]]
    choices.append([("I" * len(g), g, 2 * len(g)) for g in gaps])
    for parts in product(*choices):
        if RULE.match("".join(p[1] for p in parts)) and not re.search("[^sua]", "".join(p[1] for p in parts)):
            found = (sum(p[2] for p in parts), "".join(p[0] for p in parts))
            best = found if best is None else min(best, found)
    return best


def by_rows(turns):
    """The same by states row by row, for longer conversations."""
    after = cr.AFTER
    states = {0: (0, "")}
    for t in [*turns, None]:
        for _ in range(3):
            grown = dict(states)
            for q, (cost, audit) in states.items():
                for role in "ua":
                    if (q, role) in after:
                        p = after[q, role]
                        grown[p] = min(grown.get(p, (1 << 60, "")), (cost + 2, audit + "I"))
            states = grown
        if t is None:
            return min(states[q] for q in (0, 3) if q in states)
        new = {}
        for q, (cost, audit) in states.items():
            steps = [(q, 3, "D")]
            if not t.gone:
                steps += [(after[q, t.initial], int(t.truncated), "K")] if (q, t.initial) in after else []
                steps += [(after[q, r], 2 + t.truncated, "R") for r in "ua" if (q, r) in after]
            for p, more, letter in steps:
                new[p] = min(new.get(p, (1 << 60, "")), (cost + more, audit + letter))
        states = new


TURN = st.builds(lambda r, g, x: Turn(r, g, x and not g), st.sampled_from(["s", "u", "a", "t", ""]), st.booleans(), st.booleans())


@settings(max_examples=150, deadline=None)
@given(st.lists(TURN, max_size=3))
def test_search_against_all_edits(turns):
    assert cheapest(turns) == all_edits(turns)


@settings(max_examples=200, deadline=None)
@given(st.lists(TURN, max_size=30))
def test_search_against_rows(turns):
    cost, audit = cheapest(turns)
    assert (cost, audit) == by_rows(turns)
    rows = [(t.initial, str(i)) for i, t in enumerate(turns)]
    assert RULE.match("".join(line[0] for line in edited(audit, rows)))


def plain(rows, present):
    """Contract columns of every conversation, from the rows after damage."""
    groups = defaultdict(list)
    for r, here in zip(rows, present, strict=True):
        groups[r[0]] += [r[1:]] if here else []
    out = {}
    for conv, own in groups.items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, turns, counts = set(), [], [0, 0, 0]
        for _, role, text in own:
            bare = text.strip(BLANK)
            fault = 0 if not bare else 1 if (role, text) in seen else 2 if bare[-1] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                counts[fault] += 1
            turns.append(Turn(role[:1], fault < 2, fault == 2))
        cost, audit = by_rows(turns)
        text = "\n".join(edited(audit, [r[1:] for r in own]))
        numbers = [r[0] for r in own if r[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a.initial + b.initial not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

@pytest.mark.parametrize("piece_rows", [1, 3, 2048])
def test_pieces_and_whole_conversations(ready, monkeypatch, piece_rows):
    """Conversations of any length over several ranges; pieces of a few rows give what whole conversations give."""
    monkeypatch.setattr(cr, "PIECE_ROWS", piece_rows)
    pick, rows = random.Random(piece_rows), []
    for conv in [*range(12), None]:
        for _ in range(pick.choice([0, 1, 2, 5, 40])):
            rows.append((
                conv, pick.choice([None, *range(30)]), pick.choice(["user", "assistant", "system", " ", "", "tool"]),
                pick.choice(["Yes.", "no", " ", "", "What?\n", "A! b", "x "]), pick.random() < 0.9,
            ))
    table = ready.createDataFrame(rows, "conv_id long, turn long, role string, text string, present boolean")
    table = table.withColumns({"audit": F.lit(1), "part": F.lit("clash")})
    got = repair(table, F.col("present"), texts=True).collect()
    want = plain([r[:4] for r in rows], [r[4] for r in rows])
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in got} == want and len(got) == len(want)
    assert all(hashlib.sha256(r["repaired"].encode()).hexdigest() == r["repaired_sha256"] for r in got)


def test_damage(ready):
    rows = ready.read.parquet(f"{FOLDER}/conversations.parquet")
    extra = ready.createDataFrame(
        [(None, None, None, None), (None, 3, "user", "Hi."), (900, None, None, "x"), (901, 19, None, None)],
        "conv_id long, turn long, role string, text string",
    )
    rows = rows.unionByName(extra).cache()
    want, present = [], []
    for r in rows.collect():
        conv, turn, role, text = r
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        for _ in range(2 if fault == 3 else 1):
            want.append((conv, turn, "user" if fault == 4 else role, text))
            present.append(fault != 0)
    got = [tuple(r) for r in damaged(rows).collect()]
    assert sorted(map(str, got)) == sorted(str((*w, p)) for w, p in zip(want, present, strict=True))
    done = repair(damaged(rows), F.col("present")).collect()
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in done} == plain(want, present)
    assert repair(damaged(rows.limit(0)), F.col("present")).count() == 0
