"""Filter audit: tries against dictionaries, the audit against a walk of every order over every document."""

from collections import Counter, defaultdict
from itertools import permutations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import awkward, nothing, ready  # noqa: F401
from pyspark.sql import functions as F

from larkspur.llm import text_trie as tt
from larkspur.llm.filter_audit import audit, audit_filters, effects, judged, usual_filters
from larkspur.llm.text_trie import Node, insert, mark_copies

FOLDER = "/root/testdata/sf0.001"
BLANKS = " \t\n\x0b\f\r"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6).map(lambda b: bytes(x % 3 for x in b)), st.one_of(st.none(), st.integers(0, 9)))))
def test_trie_keeps_least_ids(rows):
    root, least = Node(), {}
    ends = [insert(root, text, id) for text, id in rows]
    for text, id in rows:
        if id is not None:
            least[text] = min(id, least.get(text, id))
    for (text, _), end in zip(rows, ends, strict=True):
        assert end.least == least.get(text) and insert(root, text, None) is end

    def compressed(node, top):
        assert top or len(node.edges) != 1 or node.least is not None or node in ends
        for first, (label, below) in node.edges.items():
            assert label[0] == first
            compressed(below, False)

    compressed(root, True)


def copies(rows):
    least = {}
    for id, text in rows:
        if id is not None:
            least[text or ""] = min(id, least.get(text or "", id))
    return Counter((id, text or "", id is not None and least[text or ""] < id) for id, text in rows)


@pytest.mark.parametrize("limit,trie", [(256 << 10, 16 << 20), (600, 1), (70, 200)])
def test_copies_over_many_levels(ready, monkeypatch, limit, trie):
    """Long shared beginnings, one text in a third of all rows, texts that end where others go on."""
    monkeypatch.setattr(tt, "LEAST_LIMIT", limit)
    monkeypatch.setattr(tt, "TRIE", trie)
    hot, long = "the same text " * 9, "a" * 700
    texts = [hot] * 60 + [long + str(i % 7) for i in range(40)] + [long[:n] for n in (8, 32, 128, 512, 7, 31, 8, 512)]
    texts += [f"text {i % 30}" for i in range(60)] + [None, "", None, "", "é" * 5, "é" * 5, "é" * 4]
    rows = [(None if i % 17 == 5 else (i * 37) % 101, t) for i, t in enumerate(texts)]
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(5)
    docs = docs.withColumns({"_text": F.lit("clash"), "copy": F.lit(1), "_group": F.lit(2)})
    handed = {"id": F.col("_id"), "text": F.col("_text"), "other": F.col("row.copy")}
    got = mark_copies(docs, "doc_id", "text", handed)
    assert Counter((r["id"], r["text"], r["copy"]) for r in got.collect()) == copies(rows)
    assert got.columns == ["id", "text", "other", "copy"]


def test_copies_of_awkward_rows(ready, awkward, nothing):
    handed = {"id": F.col("_id"), "text": F.col("_text")}
    got = Counter((r["id"], r["text"], r["copy"]) for r in mark_copies(awkward, "doc_id", "text", handed).collect())
    assert got == copies([(r["doc_id"], r["text"]) for r in awkward.collect()])
    assert mark_copies(nothing, "doc_id", "text", handed).count() == 0


def masks(rows):
    later = {(id, text): flag for id, text, flag in copies([(r[0], r[1]) for r in rows])}
    for id, text, lang in rows:
        text = text or ""
        words = [w for w in __import__("re").split(f"[{BLANKS}]+", text) if w]
        yield id, lang or "", (
            (len(words) < 100)
            + 2 * (100 * len(set(words)) < 80 * len(words))
            + 4 * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text))
            + 8 * any(c in "#$%&*|" for c in text)
            + 16 * later[id, text]
        )


def walked(rows, labels):
    """Every order, step by step, over every document."""
    good, toxic = ({i for i, q, t in labels if (q, t)[k] == 1} for k in (0, 1))
    out = {}
    by_part = defaultdict(list)
    for id, part, mask in masks(rows):
        by_part[part].append((id, mask))
    for part, own in by_part.items():
        removed = Counter()
        for order in permutations("ABCDE"):
            gone = set()
            for step, letter in enumerate(order, 1):
                bit = 1 << "ABCDE".index(letter)
                here = {k for k, (_, m) in enumerate(own) if m & bit and k not in gone}
                again = sum(1 for k, (_, m) in enumerate(own) if m & bit and k in gone)
                gone |= here
                removed[letter] += len(here)
                out[part, "".join(order), step] = [
                    len(own) - len(gone), len(here), again, sum(m == bit for _, m in own),
                    sum(own[k][0] in good for k in here), sum(own[k][0] in toxic for k in here),
                ]
        for (p, order, step), found in out.items():
            if p == part:
                found.append(removed[order[step - 1]])
    return out


COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def as_dict(df):
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in df.collect()}


def test_audit_against_a_walk(ready):
    docs = ready.read.parquet(f"{FOLDER}/documents.parquet")
    labels = ready.read.parquet(f"{FOLDER}/labels.parquet")
    want = walked([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    got = audit_filters(docs, labels)
    assert as_dict(got) == want and got.count() == 600 * docs.select("lang").distinct().count()


def test_audit_of_awkward_rows(ready, awkward, nothing):
    labels = ready.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (None, 1, 1), (7, None, 1), (3, 1, None)], "doc_id long, quality int, toxic int"
    )
    docs = awkward.withColumn("lang", F.col("source"))
    want = walked([(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()],
                  [tuple(r) for r in labels.where("doc_id is not null").collect()])
    assert as_dict(audit_filters(docs, labels)) == want
    assert audit_filters(nothing.withColumn("lang", F.lit("x")), labels).count() == 0
    assert audit_filters(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_other_filters(ready):
    docs = ready.createDataFrame([(1, "short", "x"), (2, "short", "y"), (3, "long enough", "x")], "doc_id long, text string, lang string")
    rows = judged(docs, {"L": F.length("_text") < 6}, "C", "lang")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "x", 1), (2, "y", 3), (3, "x", 0)]
    labels = ready.createDataFrame([], "doc_id long, quality int, toxic int")
    got = audit(rows, labels, "LC").where("part = 'y' and step = 2").collect()
    assert {(r["filter_order"], r["removed"], r["redundant"], r["shapley"]) for r in got} == {("LC", 0, 1, 1), ("CL", 0, 1, 1)}
    assert len(effects("AB")) == 2 * 2 * 4 and set(usual_filters(F.col("_text"))) == set("ABCD")
