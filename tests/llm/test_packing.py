"""Best-fit packing: the plan against a loop over single pieces, the ids against the tokenizer's library."""

import json
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import awkward, nothing, ready  # noqa: F401
from tokenizers import Tokenizer

from larkspur.llm import packing
from larkspur.llm.packing import Encoder, OpenSequences, best_fit, keeps_to_words, pack_documents, sequences

public = pytest.importorskip("public_tokenizers")
VOCABULARY = public.path("word_bpe_49k.json")


def one_by_one(counts, capacity):
    """Tokens in each sequence, by the loop over single pieces."""
    room = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = bisect_left(room, length)
            left = (room.pop(at) if at < len(room) else capacity) - length
            insort(room, left)
    return sorted(capacity - r for r in room)


def laid_out(counts, capacity):
    runs, n = best_fit(counts, capacity)
    used = [0] * n
    ends = [*runs[1:, 0], sum(counts.values())][: len(runs)]
    for (first, length, each, sequence, before), end in zip(runs, ends, strict=True):
        for k in range(end - first):
            at = sequence + k // each
            assert used[at] == before + k % each * length  # no gaps
            used[at] += length
    return sorted(used)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 70).flatmap(
    lambda c: st.tuples(st.dictionaries(st.integers(1, c), st.integers(1, 15), max_size=15), st.just(c))))
def test_plan_is_best_fit_decreasing(case):
    counts, capacity = case
    assert laid_out(counts, capacity) == one_by_one(counts, capacity)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 40), st.lists(st.tuples(st.integers(1, 40), st.booleans()), max_size=40), st.integers(1, 40))
def test_tightest_room(capacity, steps, length):
    open_, have = OpenSequences(capacity), []
    for room, take in steps:
        if take and have:
            have.remove(room := have[-1])
            open_.take(room)
        elif room <= capacity:
            open_.add(room, 0, 1)
            have.append(room)
    want = min((r for r in have if r >= length), default=None)
    assert length > capacity or open_.tightest(length) == want


def test_plan_does_not_grow_with_the_corpus():
    few, many = ({n: times * (n % 7 + 1) for n in range(1, 4097)} for times in (10, 10**9))
    assert len(best_fit(many, 4096)[0]) < 4096 * 12 and len(best_fit(few, 4096)[0]) < 4096 * 12
    total = sum(n * k for n, k in many.items())
    assert best_fit(many, 4096)[1] <= 1.01 * total / 4096
    with pytest.raises(ValueError, match="does not fit"):
        best_fit({9: 1}, 8)


LIBRARY, ENCODER = Tokenizer.from_file(VOCABULARY), Encoder(VOCABULARY)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def check(rows, packed, capacity):
    """Pieces are the library's ids, sequences are gapless, and as many as best fit needs."""
    spare = defaultdict(list)
    for doc_id, text in rows:
        spare[doc_id].append([*library(text), 1])
    pieces, used, counts = defaultdict(list), defaultdict(list), defaultdict(int)
    for r in packed:
        pieces[r["doc_id"]].append(r)
        used[r["sequence_id"]].append((r["offset"], r["length"]))
        counts[r["length"]] += 1
    assert set(pieces) == set(spare)
    for doc_id, own in pieces.items():
        want = sorted(
            (k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(np.array(ids[k : k + capacity], "<u4").tobytes()))
            for ids in spare[doc_id] for k in range(0, len(ids), capacity)
        )
        assert sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in own) == want
    for spans in used.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(used) == len(one_by_one(counts, capacity))


@pytest.mark.parametrize("capacity", [64, 4096])
def test_documents(ready, capacity):
    docs = ready.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check(rows, pack_documents(docs, VOCABULARY, capacity, 1).collect(), capacity)


def test_awkward_rows(ready, awkward, nothing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    packed = pack_documents(awkward, VOCABULARY, 1000, 1, with_ids=True).cache()
    check(rows, packed.collect(), 1000)
    assert pack_documents(nothing, VOCABULARY, 1000, 1).count() == 0
    parts = defaultdict(list)
    for p in packed.collect():
        parts[p["sequence_id"]].append((p["offset"], bytes(p["ids"])))
    got = {r["sequence_id"]: bytes(r["ids"]) for r in sequences(packed).collect()}
    assert got == {k: b"".join(ids for _, ids in sorted(own)) for k, own in parts.items()}


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60), st.integers(1, 30))
def test_words_give_the_same_ids(text, piece):
    text = text.encode("utf-8", "ignore").decode() + "́ <|endoftext|>  Σ  it's"
    own, was = ENCODER, packing.PIECE
    try:
        packing.PIECE = piece
        for raw in own.ids([text.encode()]), own.ids([text.encode(), b""])[:1]:
            assert np.frombuffer(raw[0], "<u4").tolist() == library(text)
    finally:
        packing.PIECE = was


def test_other_tokenizers_get_whole_texts():
    with open(VOCABULARY, encoding="utf-8") as file:
        assert keeps_to_words(json.load(file))
    other = public.path("byte_bpe_50k.json")
    with open(other, encoding="utf-8") as file:
        assert not keeps_to_words(json.load(file))
    text = "white  space\n counts here"
    ids = Tokenizer.from_file(other).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(Encoder(other).ids([text.encode()])[0], "<u4").tolist() == ids
