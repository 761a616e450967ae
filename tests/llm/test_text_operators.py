"""Decontamination, language model, token counts, toxicity, web pages."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from brute import blank_words, contamination
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import awkward, nothing, ready  # noqa: F401
from pyspark.sql import functions as F

from larkspur.llm import decontaminate as dc
from larkspur.llm.html_text import ARTICLE, BOILERPLATE, blocks_of, main_text
from larkspur.llm.kneser_ney import KneserNey, discounts
from larkspur.llm.queries import held_out
from larkspur.llm.token_counts import PrefixCounts, token_counts
from larkspur.llm.toxicity import BEGINNINGS, FEATURES, Toxicity, _lexicon, reject_toxic

public = pytest.importorskip("public_tokenizers")
VOCABULARY = public.path("word_bpe_49k.json")


ITEMS = [(1, "one two three four five six seven eight nine ten eleven"), (2, "Short ITEM, here!"), (3, None), (4, " .. "),
         (5, "one two three four five six seven eight nine ten"), (10, "café 中文 x1")]
TEXTS = ["zero ONE-two three four five six seven eight nine ten eleven twelve", "a short item here short item here b",
         "one two three four five six seven eight nine", None, "", "x café 中文... X1 y"]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_contamination(ready, block_bytes):
    docs = ready.createDataFrame(list(enumerate(TEXTS)) + [(0, TEXTS[0])], "doc_id long, text string")
    bench = ready.createDataFrame(ITEMS, "item_id long, text string")
    got = dc.contamination(docs, bench, block_bytes=block_bytes).withColumn("sha", dc.items_digest()).collect()
    want = contamination(TEXTS, ITEMS)
    for r in got:
        n, hit, items, sha, _ = want[r["doc_id"]]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["sha"]) == (n, hit, items, sha)
        raw = (TEXTS[r["doc_id"]] or "").encode()
        spans = [raw[s["begin"] : s["end"]].decode() for s in r["spans"]]
        assert len(spans) == (1 if hit and r["doc_id"] != 1 else 1 if hit else 0)
        if r["doc_id"] == 0:
            assert spans == ["ONE-two three four five six seven eight nine ten eleven"]
    clean = dc.decontaminate(docs, bench, block_bytes=block_bytes)
    assert sorted(r["doc_id"] for r in clean.collect()) == [2, 3, 4]


def test_contamination_of_awkward_rows(ready, awkward, nothing):
    bench = ready.createDataFrame([(None, "gamma delta"), (1, None)], "item_id long, text string")
    got = dc.contamination(awkward, bench)
    assert got.count() == 11 and got.where("n_hit > 0").count() == 3
    kept = dc.decontaminate(awkward, bench)
    assert kept.columns == awkward.columns and kept.count() == 8
    assert dc.decontaminate(awkward, bench.limit(0)).count() == 11
    assert dc.contamination(nothing, bench).count() == 0


def reference_model(texts, train):
    tokens = [["<s>", *blank_words(t), "</s>"] for t in texts]
    pairs, count = Counter(), Counter()
    for t, use in zip(tokens, train, strict=True):
        if use:
            pairs.update(zip(t, t[1:], strict=False))
            count.update(t[1:])
    after, before, kinds = Counter(), Counter(), defaultdict(lambda: [0, 0, 0])
    for (a, b), n in pairs.items():
        after[a] += n
        before[b] += 1
        kinds[a][min(n, 3) - 1] += 1

    def rates(values):
        return discounts(*(sum(v == k for v in values) for k in (1, 2, 3, 4)))

    high, low = rates(pairs.values()), rates(before.values())
    total, words, n_tokens = sum(before.values()), len(count), sum(count.values())

    def alone(b):
        if not total:
            return 1.0
        share = sum(low[min(v, 3)] for v in before.values()) / total
        return (before[b] - low[min(before[b], 3)]) / total + share / (words + 1)

    def chance(a, b):
        if not after[a]:
            return alone(b)
        n = pairs[a, b]
        rest = sum(high[k + 1] * kinds[a][k] for k in range(3)) / after[a]
        return (n - high[min(n, 3)]) / after[a] + rest * alone(b)

    out = []
    for t in tokens:
        base = sum(math.log10((count[b] + 0.1) / (n_tokens + 0.1 * (words + 1))) for b in t[1:])
        score = sum(math.log10(chance(a, b)) for a, b in zip(t, t[1:], strict=False))
        out.append((len(t) - 1, sum(count[b] > 0 for b in t[1:]), n_tokens, base, score))
    return out


def test_kneser_ney_is_the_formula(ready):
    texts = ["the cat sat on the mat", "the dog sat on the log", "A cat and a dog", None, "", "the the the the",
             "unseen words only", "on the mat the cat"] * 6
    rows = list(enumerate(texts))
    train = [zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    docs = ready.createDataFrame(rows, "doc_id long, text string").repartition(3)
    model = KneserNey.fit(docs.where(~held_out(F.col("doc_id"), 10)))
    got = {r["doc_id"]: r for r in model.score(docs).collect()}
    for k, (n, known, total, base, score) in enumerate(reference_model(texts, train)):
        r = got[k]
        assert (r["n_tokens"], r["n_known"], model.facts["tokens"]) == (n, known, total)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score)


def test_kneser_ney_of_awkward_rows(awkward, nothing):
    model = KneserNey.fit(awkward)
    got = model.score(awkward)
    assert got.count() == 11 and got.where("score > 0 OR isnan(score)").count() == 0
    empty = KneserNey.fit(nothing)
    assert empty.score(awkward).where("score <> 0").count() == 0
    assert model.score(nothing).count() == 0


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_prefix_counts_are_the_library_s(text):
    from tokenizers import Tokenizer

    text = text.encode("utf-8", "ignore").decode()
    library = test_prefix_counts_are_the_library_s.__dict__.setdefault("library", Tokenizer.from_file(VOCABULARY))
    table = PrefixCounts(text, VOCABULARY)
    for end in {0, len(text) // 2, len(text)}:
        part = text[:end]
        assert table.at(len(part.encode())) == len(library.encode(part, add_special_tokens=False).ids)
    inside = text.encode()[: table.within(3)].decode()
    assert len(library.encode(inside, add_special_tokens=False).ids) <= 3


def test_token_counts(ready, awkward, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    texts = ["Hello, World's <|endoftext|> end", "a<|startoftext|>b", "café café ẞ İ", "x" * 5_000, None]
    rows = ready.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in token_counts(rows, VOCABULARY, 3).collect():
        n = len(library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids)
        assert (r["n_tokens"], r["over_limit"]) == (n, n > 3)
    assert token_counts(awkward, VOCABULARY, 2048).count() == 11
    assert token_counts(nothing, VOCABULARY, 2048).count() == 0


@pytest.fixture(scope="module")
def judged(ready):
    """Texts of which one in four insults; some insults are written with look-alikes."""
    plain = [f"the {w} report of day {{}} is ready for the team" for w in ("north", "south", "weekly", "final", "short")]
    rude = ["you are an idiot and a clown, day {}", "what an id1ot you are on day {}", "shut up you w0rthless clown {}"]
    texts = [(i, (rude[i // 4 % 3] if i % 4 == 0 else plain[i % 5]).format(i)) for i in range(800)]
    docs = ready.createDataFrame(texts, "doc_id long, text string")
    return docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic"))


def test_toxicity_on_rows_held_out(judged):
    docs, labels = judged
    model = Toxicity.fit(docs, labels, ~held_out(F.col("id"), 5))
    scored = model.score(docs).select("row.doc_id", "score").where(held_out(F.col("doc_id"), 5)).collect()
    assert len(scored) > 100
    assert all((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in scored)
    assert all(0 <= r["score"] <= 1 for r in scored)
    kept = reject_toxic(docs, labels, ~held_out(F.col("id"), 5))
    assert {r["doc_id"] % 4 for r in kept.collect()} == {1, 2, 3}


def test_toxicity_of_awkward_rows(ready, judged, awkward, nothing):
    docs, labels = judged
    model = Toxicity.fit(docs, labels, F.lit(True))
    assert model.score(awkward).where("score BETWEEN 0 AND 1").count() == 11
    assert model.score(nothing).count() == 0
    odd = ready.createDataFrame([(None, 1), (1, None), (5, 0), (5, 0)], "doc_id long, toxic int")
    alone = reject_toxic(awkward, odd, F.lit(True))
    assert alone.count() == 11 and alone.columns == awkward.columns
    assert len(FEATURES) == 20


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<header class="x">Site</header><nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- no <p>x</p> -->
<div id="cookie-notice">We use cookies</div><article><header><h1>Title &amp; more</h1><span>by me</span></header>
<p>First&nbsp;line<br>and   more <b>bold<p>Second &lt;b&gt; &#233;<div class="ad">Buy</div><ul><li>one<li>two</ul>
<table><tr><td>a</td><td>b</td></tr></table><form><p>Mail</p></form><section class="comments"><p>Nice!</p></section>
<p>Last</article><aside>More</aside><footer>&copy; 2024</footer></body></html>"""


def test_blocks_of_an_article():
    got = [t for level, t in blocks_of(PAGE) if level == ARTICLE]
    assert got == ["Title & more", "First line and more bold", "Second <b> é", "one", "two", "a b", "Last"]
    assert (BOILERPLATE, "© 2024") in blocks_of(PAGE)
    assert blocks_of(None) == [] and blocks_of("<p>a<article>b") == [(1, "a"), (3, "b")]


def test_pages_without_articles_lose_what_their_host_repeats(ready):
    menu = "home news sport weather travel money help contact"
    rows = [(i, f"https://h.example/{i}", f"<div>{menu}</div><p>own text of page number{i} goes here</p><div>legal "
             f"terms and privacy of this house</div>") for i in range(40)]  # fmt: skip
    rows += [(100, "https://other.example/", f"<div>{menu}</div>"), (101, None, None), (102, "x", ""), (None, "y", "<p>z"),
             (103, "https://h.example/a", f"<article><p>{menu}</p></article>")]
    pages = ready.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = {r["page_id"]: r for r in main_text(pages).collect()}
    assert len(got) == 45
    for i in range(40):
        assert got[i]["text"] == f"own text of page number{i} goes here" and got[i]["n_chars"] == len(got[i]["text"])
    assert got[100]["text"] == menu and got[103]["text"] == menu and got[101]["text"] == "" and got[None]["text"] == "z"
    assert main_text(pages.limit(0)).count() == 0


def test_page_text_is_that_of_the_article(ready):
    import html
    import re

    pages = ready.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in main_text(pages).collect()}
    for page in pages.collect():
        inner = re.search("<article>(.*?)</article>", page["html"], re.S)[1]
        parts = re.split("</?(?:p|h1)>", inner.replace("<br>", " "))
        plain = [" ".join(html.unescape(re.sub("<[^>]+>", "", p)).split()) for p in parts]
        assert got[page["page_id"]] == "\n\n".join(p for p in plain if p)


def test_lexicon_keeps_rare_toxic_words(ready):
    """A word or beginning of two toxic texts and no other is an entry, however many terms there are."""
    rows = [(k, k % 4, 10, 1) for k in range(5000)] + [(10_000 + kind, kind, 2, 2) for kind in range(len(BEGINNINGS) + 1)]
    rows += [(20_000 + k, k % 4, 6, 2) for k in range(40)]  # two of six may be chance
    found = _lexicon(ready.createDataFrame(rows, "term long, kind int, rows long, toxic long"), 0.1).collect()
    assert BEGINNINGS == (4, 5, 6)
    assert sorted((r["kind"], r["term"]) for r in found) == [(kind, 10_000 + kind) for kind in range(4)]


def test_a_lexicon_of_any_size(ready):
    """More entries than any list of the commonest would hold; all are found again, negative hashes too."""
    import numpy as np

    from larkspur.llm.kernels import mix
    from larkspur.llm.toxicity import _entries, _stored, _weights

    terms = mix(np.arange(1, 40_001, dtype=np.uint64)).view(np.int64)
    rows = ready.createDataFrame([(int(t), i % 4, float(i)) for i, t in enumerate(terms)], "term long, kind int, weight double")
    path = _stored(ready, [rows, rows.limit(0)])
    for kind, entries in enumerate(_entries(path, 0)):
        own = np.arange(40_000) % 4 == kind
        got = _weights(terms.view(np.uint64), entries)
        assert (got == np.where(own, np.arange(40_000.0), 0)).all()
    assert not _weights(terms.view(np.uint64), _entries(path, 1)[0]).any()


def test_workers_import_no_more_than_they_use():
    """The module whose functions workers run brings neither pyspark.ml nor pandas into their memory."""
    import subprocess
    import sys

    code = "import sys, larkspur.llm.toxicity; print([m for m in sys.modules if m.startswith('pyspark.ml') or m == 'pandas'])"
    assert subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True).stdout.strip() == "[]"
