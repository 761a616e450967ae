"""Top-k search, source mixing, the pipeline, and the registered queries against their SQL twins."""

import math
import random
from collections import Counter, defaultdict

import pytest
from brute import components, contamination, top_k
from check_queries import compare, connect
from conftest import FOLDER
from llm_fixtures import awkward, nothing, ready  # noqa: F401
from pyspark.sql import functions as F

import corpus_pipeline
from larkspur.llm import topk
from larkspur.llm.mixing import mix_sources
from larkspur.llm.paragraph_dedup import passages
from larkspur.llm.queries import QUERIES, TWINS
from larkspur.workspace import materialize


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_as_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, FOLDER), duck, TWINS[name]) is None


@pytest.mark.parametrize("blocks", [(2048, 256), (16, 4)])
def test_top_k_is_exact(ready, monkeypatch, blocks):
    monkeypatch.setattr(topk, "BLOCK", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(5)]
    vectors = [(i, [c + rng.gauss(0, 0.05) for c in centres[i % 5]]) for i in range(300)]
    vectors += [(400 + i, vectors[3][1]) for i in range(20)]  # ties
    odd = [(1_000, None), (1_001, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1_010, [float("nan")] * 6), (1_020, []),
           (None, vectors[0][1]), (2_000, [float("inf")] * 6)]
    table = ready.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in topk.top_k(table, F.col("id") % 10 == 0, 7).collect())
    assert got == sorted(top_k(vectors, [i for i, _ in vectors if i % 10 == 0], 7))


def test_top_k_of_few_rows(ready):
    rows = ready.createDataFrame([(0, [1.0]), (1, [2.0]), (100, [3.0, 4.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(rows, F.col("id") % 100 == 0).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk.top_k(rows.limit(0), F.col("id") % 100 == 0).count() == 0


def placed(ready, sizes, weights, block_rows=4, resolution=100):
    rows = [(s, i) for s, n in sizes.items() for i in range(n)]
    docs = ready.createDataFrame([(k, s, str(i)) for k, (s, i) in enumerate(rows)], "doc_id long, source string, text string")
    return mix_sources(docs, weights, block_rows, resolution).orderBy("position").collect()


def test_mixture_keeps_weights_within_one_block(ready):
    weights = {"a": 5.0, "b": 3.0, "c": 1.0, "d": 1.0}
    got = placed(ready, {"a": 900, "b": 400, "c": 150, "d": 37}, weights)
    assert [r["position"] for r in got] == list(range(1_487))
    shares = {"a": 50, "b": 30, "c": 10, "d": 10}
    blocks = sorted({(r["slot"], r["source"], r["block"], r["on_target"]) for r in got})
    done, slots = Counter(), defaultdict(list)
    for slot, source, block, on_target in blocks:
        # Neither before its release nor after its deadline.
        a = shares[source]
        assert block * 100 // a <= slot < -(-(block + 1) * 100 // a)
        slots[source].append(slot)
        if on_target:
            assert all(abs(done[s] - shares[s] * slot / 100) < 1 for s in shares)
        done[source] += 1
    assert len({b[0] for b in blocks}) == len(blocks)
    ends = min(-(-n // 4) * 100 / shares[s] for s, n in {"a": 900, "b": 400, "c": 150, "d": 37}.items())
    first_off = min(b[0] for b in blocks if not b[3])
    assert first_off >= math.floor(ends) - 1


def test_mixture_of_awkward_rows(ready, awkward, nothing):
    got = mix_sources(awkward)
    assert sorted(r["position"] for r in got.collect()) == list(range(11))
    assert got.columns == [*awkward.columns, "block", "slot", "position", "on_target"]
    assert mix_sources(nothing).count() == 0
    clash = mix_sources(awkward.withColumns({"slot": F.lit(-1), "own_slot": F.lit(-2), "position": F.lit("here")}))
    assert set(clash.columns) == {*got.columns, "own_slot", "own_own_slot", "own_position"} and clash.count() == 11
    assert {(r["own_slot"], r["own_own_slot"], r["own_position"]) for r in clash.collect()} == {(-2, -1, "here")}


def test_a_period_too_large_to_broadcast(ready, monkeypatch):
    from larkspur.llm import mixing

    want = placed(ready, {"a": 200, "b": 50}, None)
    monkeypatch.setattr(mixing, "BROADCAST_ENTRIES", 10)
    assert placed(ready, {"a": 200, "b": 50}, None) == want


def test_sources_without_a_weight(ready, awkward):
    with pytest.raises(Exception, match="no weight for source"):
        mix_sources(awkward, {"s": 1.0}).collect()


def test_ranks_over_many_ranges(ready, monkeypatch):
    from larkspur.llm import mixing

    monkeypatch.setattr(mixing, "RANGE_ROWS", 7)
    many = placed(ready, {"a": 200, "b": 50}, None)
    monkeypatch.undo()
    assert [(r["doc_id"], r["position"]) for r in many] == [
        (r["doc_id"], r["position"]) for r in placed(ready, {"a": 200, "b": 50}, None)
    ]


def test_pipeline_stage_by_stage(ready):
    """Each stage's decisions, by plain versions on its own input; nothing clean is lost."""
    docs = ready.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    bench = [(r["item_id"], r["text"]) for r in ready.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    toxic = {r["doc_id"] for r in ready.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 1").collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        cut = {r["key"]: r["kept"] for r in passages(docs).collect()} if name == "substring_dedup" else {}
        docs = materialize(stage(ready, docs, FOLDER), name)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert docs.columns[: len(columns)] == columns and (k == 4 or docs.columns == columns)
        kept[name] = after
        if name == "toxicity":
            gone = set(before) - set(after)
            clean = {r["doc_id"] for r in ready.read.parquet(f"{FOLDER}/labels.parquet").where("toxic = 0").collect()}
            assert len(gone & clean) <= 1 and len(gone) < 30
        elif name == "ngram_jaccard_join":
            rows = sorted(before.items())
            assert set(after) == {c for _, c in components(rows)}
        elif name == "substring_dedup":
            assert after == {i: cut.get(i, t) for i, t in before.items()}
        elif name == "benchmark_decontamination":
            found = contamination(before.values(), bench)
            assert set(after) == {i for i, f in zip(before, found, strict=True) if not f[4]}
        else:
            assert after == before
            assert sorted(r["position"] for r in docs.collect()) == list(range(len(after)))
    assert len(kept["source_mixing"]) > 100


def test_pipeline_of_awkward_rows(ready, awkward, nothing, tmp_path):
    for name in ("labels", "benchmark"):
        ready.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for rows, n in ((awkward, 8), (nothing, 0)):
        docs = rows.withColumn("lang", F.lit("en"))
        for name, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(ready, docs, str(tmp_path)), name)
        assert docs.count() == n


def test_run_is_the_stages(ready):
    whole = corpus_pipeline.run(ready, FOLDER)
    assert {"position", "slot", "block"} <= set(whole.columns) and whole.count() > 100
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
