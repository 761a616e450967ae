"""A corpus cleaned and mixed in stages; every stage works on all that the one before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and reads it back as the next
one's docs. All but the last return the columns of ``documents``; the last adds where each document stands in the mixture.

Defined results: an empty table passes through every stage; null texts are never toxic by themselves, have no shingles,
nothing repeated and nothing contaminated, and stay; extra columns stay with their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm.decontaminate import decontaminate
from larkspur.llm.jaccard_join import keep_one_of_each
from larkspur.llm.mixing import mix_sources
from larkspur.llm.paragraph_dedup import remove_passages
from larkspur.llm.queries import held_out
from larkspur.llm.settings import prepared
from larkspur.llm.toxicity import reject_toxic
from larkspur.workspace import materialize


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go; it learns from the labels of the rows that may be learned from."""
    return reject_toxic(docs, _table(prepared(spark), sf_dir, "labels"), ~held_out(F.col("id"), 5))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest id stays."""
    prepared(spark)
    return keep_one_of_each(docs)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document has go from the texts of later ones."""
    prepared(spark)
    texts = remove_passages(docs)
    if "n_chars" not in docs.columns:
        return texts
    return texts.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate(docs, _table(prepared(spark), sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rest, interleaved by source."""
    prepared(spark)
    return mix_sources(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_each),
    ("substring_dedup", without_passages),
    ("benchmark_decontamination", without_benchmark),
    ("source_mixing", mixed),
]

#: SQL can't express the trees of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = _table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
