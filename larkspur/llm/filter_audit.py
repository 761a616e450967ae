"""What each filter of a cleaning chain removes, in every order the chain could have.

Each document is judged once by all filters; the outcome is a mask of the filters it fails. Whether its text is a copy of an
earlier one is found by compressed tries over ranges of texts (``text_trie``). Masks are counted per part of the corpus
before anything else is asked, so the audit of all orders works on at most 2^n numbers a part: a join with the table that
says, for each order, step and mask, what that step does to a document with that mask.

Defined results: null texts count as empty; an empty text has no words, so it fails a least number of words and no share. Null
parts count as the empty string. Documents count row by row, also where ids repeat; a label belongs to all rows of its
id, and one positive label among several is enough. Rows without an id have no label and are no copies. Other columns are
ignored. An empty table has no parts.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.llm.text_trie import mark_copies
from larkspur.workspace import materialize

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\f\r"


def _words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))


def usual_filters(text: Column) -> dict[str, Column]:
    """Conditions under which a text fails: A too few words, B too few distinct ones, C too many capitals, D odd signs."""
    words = _words(text)
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * F.size(words),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")) > 10 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


def judged(
    docs: DataFrame, filters: Mapping[str, Column], copies: str, part: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``part`` and ``mask`` of every document; bit k of the mask is the k-th filter, the last one named ``copies``.

    ``filters`` are conditions over ``_text``.
    """
    bits = [F.when(condition, 1 << k).otherwise(0) for k, condition in enumerate(filters.values())]
    handed = {
        "id": F.col("_id"),
        "part": F.coalesce(F.col(f"row.`{part}`").cast("string"), F.lit("")),
        "mask": reduce(lambda a, b: a + b, bits, F.lit(0)),
    }
    marked = mark_copies(docs, id_col, text_col, handed, copies)
    return marked.select("id", "part", (F.col("mask") + F.when(F.col(copies), 1 << len(filters)).otherwise(0)).alias("mask"))


def effects(letters: str) -> list[tuple]:
    """What each step of each order does to each mask: order, step, mask, and 0 or 1 for kept, removed, redundant, unique, and
    the orders in which its filter is the one that removes the mask."""
    found = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            for mask in range(1 << len(letters)):
                fails, gone = bool(mask & bit), bool(mask & before)
                # Of the filters that a document fails, each comes first equally often.
                share = factorial(len(letters)) // mask.bit_count() if fails else 0
                found.append((
                    "".join(order), step, mask, int(not fails and not gone), int(fails and not gone), int(fails and gone),
                    int(mask == bit), share,
                ))
            before |= bit
    return found


def audit(rows: DataFrame, labels: DataFrame, letters: str, id_col: str = "doc_id") -> DataFrame:
    """Per part, order and step: what ``rows`` of ``judged`` lose there. At most 2^n masks a part are looked at."""
    spark = rows.sparkSession
    counts = rows.groupBy("part", "mask").agg(F.count("*").alias("n"))
    known = labels.groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    marked = rows.join(known, "id").groupBy("part", "mask").agg(F.sum("good").alias("good"), F.sum("toxic").alias("toxic"))
    counts = counts.join(marked, ["part", "mask"], "left").na.fill(0, ["good", "toxic"])
    rules = spark.createDataFrame(
        effects(letters),
        "filter_order string, step int, mask int, kept long, removed long, redundant long, alone long, share long",
    )
    n = F.col("n")
    return (
        counts.join(rules, "mask")
        .groupBy("part", "filter_order", "step")
        .agg(
            F.sum(n * F.col("kept")).alias("kept"),
            F.sum(n * F.col("removed")).alias("removed"),
            F.sum(n * F.col("redundant")).alias("redundant"),
            F.sum(n * F.col("alone")).alias("unique_fails"),
            F.sum(F.col("good") * F.col("removed")).alias("good_lost"),
            F.sum(F.col("toxic") * F.col("removed")).alias("toxic_lost"),
            F.sum(n * F.col("share")).alias("shapley"),
        )
    )


def audit_filters(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """The audit of the usual filters and of copies (E), in all 120 orders."""
    filters = usual_filters(F.col("_text"))
    rows = materialize(judged(docs, filters, "E", part), "judged")
    return audit(rows, labels, "".join(filters) + "E")
