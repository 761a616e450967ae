"""Suffix-array removal, Jaccard join, passages, components, suffix order."""

import random

import numpy as np
import pyarrow as pa
import pytest
from brute import components, repeats
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import awkward, nothing, ready  # noqa: F401

from larkspur.llm.components import connected_components
from larkspur.llm.jaccard_join import _POSTED, _crossings, _Outlines, jaccard_components, keep_one_of_each, outline
from larkspur.llm.paragraph_dedup import passage_report, passages, remove_passages, tune
from larkspur.llm.suffix_array import suffix_order, token_order
from larkspur.llm.suffix_dedup import remove_repeats

LETTERS = "abcdefgh"


def texts(seed, n):
    """Random texts, with exact copies, near copies, shared passages and periodic ones."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(LETTERS) for _ in range(rng.randint(1, 5)))
    passage = " ".join(word() for _ in range(60))
    out = []
    for k in range(n):
        words = [word() for _ in range(rng.randint(0, 80))]
        kind = k % 8
        if kind == 1 and out:
            words = rng.choice(out).split(" ")
        elif kind == 2 and out:
            words = rng.choice(out).split(" ")
            words[rng.randrange(len(words))] = word()
        elif kind == 3:
            words[len(words) // 2 :] = [passage, *words[len(words) // 2 :]]
        elif kind == 4:
            words = [word() for _ in range(3)] * rng.randint(2, 30)
        out.append(" ".join(words))
    return out


@given(st.lists(st.integers(1, 3), max_size=80), st.integers(1, 6))
@settings(max_examples=200, deadline=None)
def test_suffix_order(values, repeat):
    text = np.array([*(values * repeat), 0])
    raw = bytes(text.astype(np.uint8))
    want = sorted(range(len(raw)), key=lambda i: raw[i:])
    assert suffix_order(text, len(text) + 1).tolist() == want
    assert token_order(text * 1_000_003, len(text) + 1).tolist() == want


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_are_those_of_brute_force(ready, seed):
    rows = [(int(i), t) for i, t in enumerate(texts(seed, 60))]
    rows += [(7, rows[7][1]), (7, rows[3][1]), (None, rows[5][1]), (61, None), (62, "")]
    random.Random(seed).shuffle(rows)
    table = ready.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeats(table, 40).drop("spans").collect()
    want = [(k, *r) for (k, _), r in zip(rows, repeats(rows, 40), strict=True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_strings_split_over_parts_of_a_long_text(ready):
    rng = random.Random(5)
    block = "".join(rng.choice(LETTERS) for _ in range(3 << 20))
    rows = [(1, block + "-" + block[10_000:30_000]), (2, block[5_000:5_150])]
    got = {r["doc_id"]: r for r in remove_repeats(ready.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["n_removed"] == 20_000 and got[2]["n_removed"] == 150 and got[2]["n_spans"] == 1


def test_repeats_of_awkward_rows(awkward, nothing):
    got = remove_repeats(awkward).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == 11 and by_id[6]["n_removed"] == by_id[6]["n_bytes"] > 1_000_000
    # The long text has one number for each word, so nothing in it repeats.
    assert by_id[5]["n_removed"] == 0 and by_id[2]["n_bytes"] == 0
    assert remove_repeats(nothing).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_are_those_of_brute_force(ready, seed):
    rows = [(int(i) * 3 + 1, t) for i, t in enumerate(texts(seed, 120))]
    base = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen".split()
    for k in range(40):  # near copies that link in chains
        words = list(base) * 3
        words[(k * 7) % 48] = f"z{k}"
        words += [f"t{j}" for j in range(k % 5)]
        rows.append((1_000 + k, " ".join(words)))
    rows += [(1, rows[0][1]), (None, rows[5][1]), (None, None), (2_000, ""), (2_001, "A b C"), (2_002, "a B c")]
    table = ready.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in jaccard_components(table).collect()]
    want = [(k, n, c if n else k) for (k, _), (n, c) in zip(rows, components(rows), strict=True)]
    assert sorted(map(str, got)) == sorted(map(str, want))
    kept = keep_one_of_each(table).collect()
    groups = {c for _, n, c in want if n}
    assert len(kept) == len(groups) + sum(1 for _, n, _ in want if not n)


def test_jaccard_of_awkward_rows(awkward, nothing):
    got = {(r["doc_id"], r["component_id"]) for r in jaccard_components(awkward).collect()}
    assert {(5, 5), (6, 5), (1, 1), (7, 1), (2, 2), (3, 3), (4, 4), (None, None), (8, 8), (9, 9)} == got
    kept = keep_one_of_each(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "5", "8", "9", "None"]
    assert jaccard_components(nothing).count() == 0 and keep_one_of_each(nothing).count() == 0


def test_components(ready):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (300, 200), (200, 250)]
    got = {tuple(r) for r in connected_components(ready.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(100, 100), (101, 100), (300, 200), (250, 200), (200, 200)}
    assert connected_components(ready.createDataFrame([], "a long, b long")).count() == 0


def test_bands_give_the_recall(ready):
    bands, rows = tune(0.75, 0.999)
    assert 1 - (1 - 0.75**rows) ** bands >= 0.999
    with pytest.raises(ValueError):
        tune(0.1, 0.999)


def sentence(rng, n):
    return (" ".join("".join(rng.choice(LETTERS) for _ in range(6)) for _ in range(n)) + ".").capitalize()


def test_passages(ready):
    rng = random.Random(3)
    own = lambda: " ".join(sentence(rng, 9) for _ in range(4))
    passage = " ".join(sentence(rng, 15) for _ in range(4))
    near = [f"w{i}" for i in range(60)]
    line = sentence(rng, 12)
    rows = [
        (10, f"{own()}\n{passage}\n{own()}"),
        (3, f"{own()} {passage} {own()}"),
        (20, f"{own()}\n{line}\n{own()}"),
        (21, f"{own()}\n{line}\n{own()}"),
        (30, f"{' '.join(near)}\n{own()}"),
        (31, f"{' '.join(near[:30] + ['changed'] + near[31:])}\n{own()}"),
    ]
    table = ready.createDataFrame(rows, "doc_id long, text string").repartition(2)
    cut = {r["key"]: r for r in passages(table).collect()}
    # The passage stays where it comes first; a single common line stays everywhere; a near copy of a paragraph goes.
    assert set(cut) == {10, 31}
    assert cut[10]["n_removed"] == 60 and passage not in cut[10]["kept"]
    assert cut[10]["kept"] == rows[0][1].replace(passage + "\n", "")
    assert cut[31]["n_removed"] == 60 and "changed" not in cut[31]["kept"]
    whole = {r["doc_id"]: r["text"] for r in remove_passages(table).collect()}
    assert whole[3] == rows[1][1] and whole[10] == cut[10]["kept"]


def test_near_paragraphs_against_brute_force(ready):
    """Paragraphs of random similarity: all pairs at the threshold are linked, none below it."""
    rng = random.Random(9)
    base = [[f"a{k}w{i}" for i in range(60)] for k in range(12)]
    paragraphs = []
    for words in base:
        paragraphs.append(" ".join(words))
        for changes in (1, 2, 4, 8):
            copy = list(words)
            for at in rng.sample(range(60), changes):
                copy[at] = f"n{rng.random()}"
            paragraphs.append(" ".join(copy))
    rows = list(enumerate(paragraphs))
    table = ready.createDataFrame(rows, "doc_id long, text string").repartition(3)
    gone = {r["key"] for r in passages(table).collect()}
    want = {k for (k, _), (_, least) in zip(rows, components(rows), strict=True) if least != k}
    assert gone == want


def test_passages_of_awkward_rows(awkward, nothing):
    got = remove_passages(awkward)
    assert got.columns == awkward.columns
    texts_left = {r["doc_id"]: r["text"] for r in got.collect()}
    assert got.count() == 11 and texts_left[6] == "" and len(texts_left[5]) > 1_000_000 and texts_left[2] is None
    assert passage_report(awkward).count() == 11
    assert passage_report(nothing).count() == 0 and remove_passages(nothing).count() == 0


def test_repeated_runs_against_brute_force(ready):
    """Runs of 50 words placed in mid-sentence, shared or periodic: all words of a window that stands earlier go."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice(LETTERS) for _ in range(6))
    shared = [[word() for _ in range(70)] for _ in range(3)]
    rows = []
    for k in range(40):
        words = [word() for _ in range(rng.randint(5, 60))]
        if k % 4:
            at, run = rng.randrange(len(words)), rng.choice(shared)
            a = rng.randint(0, 25)
            words[at:at] = run[a : a + rng.randint(45, 70)]
        if k % 10 == 0:
            words += [word() for _ in range(3)] * 50
        rows.append((k, " ".join(w.upper() if k % 3 == 0 else w for w in words)))
    rows += [(4, rows[9][1]), (9, rows[9][1]), (None, rows[30][1])]
    rng.shuffle(rows)
    seen, want = {}, {}
    for key, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        words = text.lower().split(" ")
        gone = set()
        for at in range(len(words) - 49):
            first = seen.setdefault(tuple(words[at : at + 50]), (text, key, at))
            if first[:2] != (text, key) or at >= first[2] + 50:
                gone.update(range(at, at + 50))
        want.setdefault(key, []).append((len(gone), " ".join(w for i, w in enumerate(text.split(" ")) if i not in gone)))
    table = ready.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in passages(table, min_paragraph=1000, min_words=1000).collect():
        got.setdefault(None if r["key"] < 0 else r["key"], set()).add((r["n_removed"], r["kept"].strip()))
    assert got == {k: v for k, v in ((k, {x for x in v if x[0]}) for k, v in want.items()) if v}


def test_near_paragraphs_that_repeat_themselves(ready):
    """A line and one that holds it three times have nearly the same shingles, though not as many."""
    rows = []
    for k in range(6):
        words = [f"r{k}w{i}" for i in range(40)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join(words * 3))]
    table = ready.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = {k for (k, _), (_, least) in zip(rows, components(rows), strict=True) if least != k}
    assert want == {1, 3, 5, 7, 9, 11} and {r["key"] for r in passages(table).collect()} == want


def test_outlines_rule_out_half_similar_sets_and_no_link():
    """Of 300 sets that share half of their members and one band, only the near copies are left to be joined."""
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 32, 45, dtype=np.uint32)
    sets = [np.unique(np.concatenate([base, rng.integers(0, 1 << 32, 20, dtype=np.uint32)])) for _ in range(300)]
    sets += [np.unique(np.concatenate([s[:-k], rng.integers(0, 1 << 32, m, dtype=np.uint32)])) for s, k, m in zip(sets[:9], range(1, 10), (0, 1, 9) * 3)]
    sizes, n = np.array([len(s) for s in sets], np.int32), len(sets)
    links = set()
    for a in range(n):
        for b in range(a + 1, n):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 75 * (sizes[a] + sizes[b] - both):
                links.add((a, b))
    kinds = {**_POSTED}
    columns = {"gram": np.ones(n), "owner": np.arange(n), "size": sizes, "place": np.zeros(n), "weight": np.ones(n)}
    posted = pa.table({c: pa.array([columns[c].astype(kind).tobytes()], pa.binary()) for c, kind in kinds.items()})
    labels = pa.table({"owner": np.arange(n), "node": np.arange(n), "label": np.arange(n)})
    outlines = pa.array([outline(s).tobytes() for s in sets], pa.binary())
    plain = _crossings(75, False)(posted, labels).num_rows
    found = _crossings(75, False)(posted, labels.append_column("outline", outlines)).to_pylist()
    found = {(row["a"], row["b"]) for row in found}
    assert links and links <= found and len(found) <= len(links) + n // 10 and plain > n * n // 3


def test_outlines_of_different_lengths_are_a_bound():
    rng = np.random.default_rng(3)
    for n in (10, 63, 64, 65, 200, 3000):
        whole = np.unique(rng.integers(0, 1 << 32, n, dtype=np.uint32))
        part = whole[rng.random(len(whole)) < 0.8]
        both = _Outlines([outline(whole).tobytes(), outline(part).tobytes()])
        linked = 100 * len(part) >= 75 * len(whole)
        one, other = (np.array([len(s)]) for s in (whole, part))
        assert both.possible(np.array([0]), np.array([1]), one, other, 75)[0] or not linked
