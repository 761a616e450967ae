"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.settings import prepared
from larkspur.plans.registry import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
TWINS: dict[str, str] = {}


def query(build: Callable[[Tables], DataFrame]):
    """Register a function of ``Tables`` under its own name."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(Tables(prepared(spark), folder))

    run.__doc__ = build.__doc__
    QUERIES[build.__name__] = run
    return build


def held_out(column, folds: int):
    """Rows whose id, as text, has a CRC-32 divisible by ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % folds == 0


@query
def op1_decontamination(t: Tables) -> DataFrame:
    from larkspur.llm.decontaminate import contamination, items_digest

    found = contamination(t.documents, t.benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", items_digest().alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )  # fmt: skip


@query
def op6_token_counts(t: Tables) -> DataFrame:
    import public_tokenizers

    from larkspur.llm.token_counts import token_counts

    return token_counts(t.documents, public_tokenizers.path("word_bpe_49k.json"), 2048)


@query
def op9_jaccard_join(t: Tables) -> DataFrame:
    from larkspur.llm.jaccard_join import jaccard_components

    return jaccard_components(t.documents)


@query
def op2_kneser_ney(t: Tables) -> DataFrame:
    from larkspur.llm.kneser_ney import KneserNey

    apart = held_out(F.col("doc_id"), 10)
    model = KneserNey.fit(t.documents.where(~apart))
    scored = model.score(t.documents)
    return scored.withColumns({"held_out": apart, "train_tokens": F.lit(model.facts["tokens"]).cast("long")})


@query
def op4_suffix_dedup(t: Tables) -> DataFrame:
    from larkspur.llm.suffix_dedup import remove_repeats

    return remove_repeats(t.documents).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op7_substring_dedup(t: Tables) -> DataFrame:
    from larkspur.llm.paragraph_dedup import passage_report

    return passage_report(t.documents)


@query
def op8_toxicity(t: Tables) -> DataFrame:
    from larkspur.llm.toxicity import Toxicity

    model = Toxicity.fit(t.documents, t.labels, ~held_out(F.col("id"), 5))
    scored = model.score(t.documents.select("doc_id", "text"))
    return scored.select(
        F.col("row.doc_id").alias("doc_id"),
        held_out(F.col("row.doc_id"), 5).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op3_source_mixing(t: Tables) -> DataFrame:
    from larkspur.llm.mixing import mix_sources

    return mix_sources(t.documents).select("doc_id", "source", "block", "slot", "position", "on_target")


@query
def op5_exact_topk(t: Tables) -> DataFrame:
    from larkspur.llm.topk import top_k

    return top_k(t.embeddings, F.col("id") % 100 == 0)


TWINS["op5_exact_topk"] = """
WITH whole AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, d.vec_id,
        list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) AS score
    FROM whole q JOIN whole d ON q.vec_id % 100 = 0 AND q.vec_id <> d.vec_id AND len(q.v) = len(d.v)
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score FROM ranked WHERE rank <= 10
"""


@query
def op10_html_text(t: Tables) -> DataFrame:
    from larkspur.llm.html_text import main_text

    return main_text(t.pages)


@query
def op11_best_fit_packing(t: Tables) -> DataFrame:
    import public_tokenizers

    from larkspur.llm.packing import pack_documents

    return pack_documents(t.documents, public_tokenizers.path("word_bpe_49k.json"), 4096, 1)


@query
def op12_conversation_repair(t: Tables) -> DataFrame:
    from larkspur.llm.conversation_repair import damaged, repair

    return repair(damaged(t.conversations), F.col("present"))


@query
def op13_filter_audit(t: Tables) -> DataFrame:
    from larkspur.llm.filter_audit import audit_filters

    return audit_filters(t.documents, t.labels)


LOWERED = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

TWINS["op1_decontamination"] = rf"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all({LOWERED.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item,
        regexp_extract_all({LOWERED.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(len(words), 10) AS n, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS w
    FROM items, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0
), held AS (
    SELECT r, i, n, array_to_string(words[i : i + n - 1], ' ') AS w
    FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(1, len(words) - n + 2)) AS t(i)
), hits AS (
    SELECT r, i, n, item FROM held JOIN windows USING (n, w)
), hit_words AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM hits) GROUP BY r
), hit_items AS (
    SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""

TWINS["op9_jaccard_join"] = rf"""
WITH RECURSIVE docs AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all({LOWERED.format('text')}, '[^\x20\x09-\x0D]+') AS words
    FROM documents
), sets AS (
    SELECT DISTINCT r, array_to_string(words[i : i + 4], ' ') AS gram
    FROM docs, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS t(i) WHERE len(words) > 0
), sizes AS (
    SELECT r, count(*) AS n FROM sets GROUP BY r
), shared AS (
    SELECT a.r AS a, b.r AS b, count(*) AS n FROM sets a JOIN sets b ON a.gram = b.gram AND a.r < b.r GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
    WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), both_ways AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reached AS (
    SELECT r AS a, r AS b FROM docs UNION SELECT reached.a, both_ways.b FROM reached JOIN both_ways ON reached.b = both_ways.a
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM docs d JOIN reached ON d.r = reached.a JOIN docs o ON o.r = reached.b LEFT JOIN sizes ON sizes.r = d.r
GROUP BY d.r, d.doc_id
"""

TWINS["op3_source_mixing"] = """
WITH RECURSIVE rows AS (
    SELECT doc_id, source, CASE WHEN source IS NULL THEN '-' ELSE '+' || source END AS s,
        md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o, text
    FROM documents
), sizes AS (
    SELECT s, count(*) AS n, CAST(round(sqrt(count(*)) * 1000000) AS HUGEINT) AS m FROM rows GROUP BY s
), whole AS (
    SELECT *, sum(m) OVER () AS total, greatest(1000, 4 * count(*) OVER ()) AS slots FROM sizes
), cut AS (
    SELECT *, (m * slots) // total AS base, (m * slots) % total AS over_ FROM whole
), dealt AS (
    SELECT s, n, CAST(greatest(1, base + CASE WHEN row_number() OVER (ORDER BY over_ DESC, s) <= slots - sum(base) OVER ()
        THEN 1 ELSE 0 END) AS BIGINT) AS a FROM cut
), shares AS (
    SELECT s, n, a, CAST(sum(a) OVER () AS BIGINT) AS q FROM dealt
), one AS (
    SELECT list(s ORDER BY s) AS names, list(a ORDER BY s) AS a, list(n ORDER BY s) AS n, any_value(q) AS q FROM shares
), slots AS (
    SELECT CAST(0 AS BIGINT) AS t, list_transform(a, lambda x: CAST(0 AS BIGINT)) AS before, CAST(NULL AS BIGINT) AS pick
    FROM one
    UNION ALL
    SELECT t + 1, list_transform(range(1, len(before) + 1), lambda i: before[i] + CASE WHEN i = p THEN 1 ELSE 0 END), p
    FROM (
        SELECT t, before, a, q, list_min(list_filter(list_transform(range(1, len(a) + 1), lambda i:
            CASE WHEN (before[i] * q) // a[i] <= t THEN ((before[i] + 1) * q + a[i] - 1) // a[i] * 100000 + i END),
            lambda x: x IS NOT NULL)) % 100000 AS p
        FROM slots, one WHERE t < q
    )
), period AS (
    SELECT t - 1 AS slot, names[pick] AS s, a[pick] AS a, q, before[pick] - 1 AS j,
        list_transform(range(1, len(a) + 1), lambda i: before[i] - CASE WHEN i = pick THEN 1 ELSE 0 END) AS earlier,
        a AS all_a, n AS all_n
    FROM slots, one WHERE pick IS NOT NULL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY s ORDER BY o, doc_id NULLS FIRST, text NULLS FIRST) - 1 AS r FROM rows
), placed AS (
    SELECT ranked.*, r // 16 AS block, (r // 16) // a AS turn, period.* EXCLUDE (s)
    FROM ranked JOIN period ON period.s = ranked.s AND period.j = (r // 16) % period.a
)
SELECT doc_id, source, CAST(block AS BIGINT) AS block, CAST(turn * q + slot AS BIGINT) AS slot,
    CAST(r % 16 + list_sum(list_transform(range(1, len(all_a) + 1),
        lambda i: least(all_n[i], 16 * (turn * all_a[i] + earlier[i])))) AS BIGINT) AS position,
    len(list_filter(range(1, len(all_a) + 1),
        lambda i: turn * all_a[i] + earlier[i] > (all_n[i] + 15) // 16)) = 0 AS on_target
FROM placed
"""

TWINS["op13_filter_audit"] = r"""
WITH judged AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x,
        regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS words,
        CAST(len(words) < 100 AS INTEGER)
        + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INTEGER)
        + 4 * CAST(100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x) AS INTEGER)
        + 8 * CAST(regexp_matches(x, '[#$%&*|]') AS INTEGER)
        + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS INTEGER) AS mask
    FROM documents
), known AS (
    SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
    FROM labels GROUP BY doc_id
), rows AS (
    SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM judged LEFT JOIN known USING (doc_id) GROUP BY part, mask
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
    SELECT a.l || b.l || c.l || d.l || e.l AS filter_order,
        [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
        AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0) AS before
    FROM orders, unnest(range(1, 6)) AS s(step)
), done AS (
    SELECT part, filter_order, step, bit, n, good, toxic, mask & bit > 0 AS fails, mask & CAST(before AS INTEGER) > 0 AS gone,
        mask = bit AS alone
    FROM rows, steps
), found AS (
    SELECT part, filter_order, step, any_value(bit) AS bit,
        coalesce(sum(n) FILTER (NOT fails AND NOT gone), 0) AS kept,
        coalesce(sum(n) FILTER (fails AND NOT gone), 0) AS removed,
        coalesce(sum(n) FILTER (fails AND gone), 0) AS redundant,
        coalesce(sum(n) FILTER (alone), 0) AS unique_fails,
        coalesce(sum(good) FILTER (fails AND NOT gone), 0) AS good_lost,
        coalesce(sum(toxic) FILTER (fails AND NOT gone), 0) AS toxic_lost
    FROM done GROUP BY ALL
), shares AS (
    SELECT part, bit, sum(removed) AS shapley FROM found GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(shapley AS BIGINT) AS shapley
FROM found JOIN shares USING (part, bit)
"""


def _edit(state: str, cost: str, letter: str, line: str | None = None, when: str = "true") -> str:
    """SQL of a state after an edit: cost, audit and lines so far, or null."""
    out = f"list_append({state}.lines, {line})" if line else f"{state}.lines"
    return (
        f"CASE WHEN {state} IS NOT NULL AND {when} THEN struct_pack(cost := {state}.cost + {cost}, "
        f"audit := {state}.audit || '{letter}', lines := {out}) END"
    )


def _insert(state: str, role: str) -> str:
    return _edit(state, "2", "I", f"'{role}:'")


def _insert_both(state: str) -> str:
    return (
        f"CASE WHEN {state} IS NOT NULL THEN struct_pack(cost := {state}.cost + 4, audit := {state}.audit || 'II', "
        f"lines := list_concat({state}.lines, ['user:', 'assistant:'])) END"
    )


def _row(state: str, initial: str, role: str | None) -> str:
    kept = _edit(state, "late", "K", "role || ':' || text", f"NOT gone AND initial = '{initial}'")
    return kept + (", " + _edit(state, "2 + late", "R", f"'{role}:' || text", "NOT gone") if role else "")


# Cheapest and least edits up to each row for each state: nothing yet (s0), system (s1), user (s2), assistant (s3).
_INSERTED = f"""list_min([s2, {_insert('s0', 'user')}, {_insert('s1', 'user')}, {_insert('s3', 'user')}]) AS u,
        list_min([s3, {_insert('s2', 'assistant')}, {_insert_both('s0')}, {_insert_both('s1')}]) AS a"""

TWINS["op12_conversation_repair"] = rf"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
        lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
            lambda x: CAST(ord(x) AS BIGINT)) AS bytes
    FROM conversations
), faults AS (
    SELECT keyed.* EXCLUDE (bytes), xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS fault
    FROM keyed, crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM faults
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
        NOT regexp_matches(text, '[^ 	-]') AS blank, left(role, 1) AS initial
    FROM damaged
), rows AS (
    SELECT *, NOT blank AND seen AS duplicate, blank OR seen AS gone,
        NOT blank AND NOT seen AND NOT regexp_matches(text, '[.!?][ 	-]*$') AS truncated,
        CAST(NOT blank AND NOT seen AND NOT regexp_matches(text, '[.!?][ 	-]*$') AS BIGINT) AS late,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
    FROM ordered
), figures AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (illegal) AS illegal
    FROM rows GROUP BY conv_id
), walk AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i,
        struct_pack(cost := CAST(0 AS BIGINT), audit := '', lines := CAST([] AS VARCHAR[])) AS s0,
        CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])) AS s1,
        CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])) AS s2,
        CAST(NULL AS STRUCT(cost BIGINT, audit VARCHAR, lines VARCHAR[])) AS s3
    FROM figures
    UNION ALL
    SELECT conv_id, i,
        {_edit('s0', '3', 'D')},
        list_min([{_edit('s1', '3', 'D')}, {_row('s0', 's', None)}]),
        list_min([{_edit('u', '3', 'D')}, {_row('s0', 'u', 'user')}, {_row('s1', 'u', 'user')}, {_row('a', 'u', 'user')}]),
        list_min([{_edit('a', '3', 'D')}, {_row('u', 'a', 'assistant')}])
    FROM (
        SELECT rows.*, s0, s1, {_INSERTED}
        FROM walk JOIN rows ON rows.conv_id IS NOT DISTINCT FROM walk.conv_id AND rows.i = walk.i + 1
    )
), ended AS (
    SELECT conv_id, figures.* EXCLUDE (conv_id, n), list_min([s0, a]) AS best
    FROM (SELECT conv_id, i, s0, {_INSERTED} FROM walk) w JOIN figures USING (conv_id) WHERE i = n
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost,
    coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN ended USING (conv_id)
"""
