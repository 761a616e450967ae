"""Keyed feature tables: key checks, upsert and change feed, all without a merge command."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from larkspur.operators.tables import insert_by_name, newest_rows, save_table
from larkspur.workspace import materialize

BUCKET = "key_bucket"

# Table properties.
_BUCKETS, _KEYS = "larkspur.buckets", "larkspur.keys"


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per offending key: how often it occurs, and whether a part of it is null."""
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("occurrences"))
        .withColumn("has_null", has_null)
        .where((F.col("occurrences") > 1) | F.col("has_null"))
    )


def check_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    found = key_violations(df, keys).limit(1).collect()
    if found:
        raise ValueError(f"key {list(keys)} is null or repeats, for example {found[0].asDict()}")
    return df


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``, the remaining columns settling ties.

    An aggregation, so a key with very many rows is reduced before the shuffle.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = [*order, *[c for c in rest if c not in order]]
    newest = F.max_by(F.struct(*rest), F.struct(*rank)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, "_row.*").select(*df.columns)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The target after merging the updates by key: known keys are replaced, new ones added.

    A column the updates lack keeps the target's value; a column only the updates have is added. One join. Keys take the
    target's type; a null in a key of the updates fails the query.
    """
    latest = latest_per_key(_complete(_typed(updates, target.schema, keys), keys), keys, order)
    columns = [*target.columns, *[c for c in latest.columns if c not in target.columns]]
    old = target.select(*keys, F.struct(*target.columns).alias("_old"))
    new = latest.select(*keys, F.struct(*latest.columns).alias("_new"))

    def value(name: str) -> Column:
        if name in keys:
            return F.col(name)
        if name not in latest.columns:
            return F.col(f"_old.{name}").alias(name)
        if name not in target.columns:
            return F.col(f"_new.{name}").alias(name)
        return F.when(F.col("_new").isNotNull(), F.col(f"_new.{name}")).otherwise(F.col(f"_old.{name}")).alias(name)

    return old.join(new, list(keys), "full_outer").select(*[value(c) for c in columns])


def _typed(updates: DataFrame, schema: StructType, columns: Sequence[str]) -> DataFrame:
    """The updates with these columns in the types of the schema, so that equal keys hash alike."""
    kinds = {f.name: f.dataType for f in schema}
    return updates.withColumns({c: F.col(c).cast(kinds[c]) for c in columns if c in kinds})


def _complete(updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The updates; a row with a null in its key fails the query."""
    missing = F.raise_error(F.lit(f"null in the key {list(keys)} of the updates"))
    kinds = {f.name: f.dataType for f in updates.schema}
    return updates.withColumns({k: F.when(F.col(k).isNull(), missing.cast(kinds[k])).otherwise(F.col(k)) for k in keys})


def load_newest(
    spark: SparkSession, source: DataFrame, name: str, keys: Sequence[str], time: str, columns: Sequence[str] = ()
) -> None:
    """Merge the source's latest load, the rows at its newest ``time``, into a stored feature table."""
    latest = newest_rows(source, time)
    merge_into(spark, name, latest.select(*columns) if columns else latest, keys)


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes between two versions: insert, delete, and both images of each update."""
    rest = [c for c in old.columns if c not in keys]
    before = old.select(*keys, F.struct(*rest).alias("_before"))
    after = new.select(*keys, F.struct(*rest).alias("_after"))

    return as_changes(before.join(after, list(keys), "full_outer"), keys)


def as_changes(images: DataFrame, keys: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """Rows before and after (``_before``, ``_after``, null where there is none) as one row per image; equal ones are dropped."""

    def change(kind: str, image: str) -> Column:
        return F.struct(F.lit(kind).alias("change"), F.col(image).alias("image"))

    updated = F.array(change("update_preimage", "_before"), change("update_postimage", "_after"))
    changes = (
        F.when(F.col("_before").isNull(), F.array(change("insert", "_after")))
        .when(F.col("_after").isNull(), F.array(change("delete", "_before")))
        .when(~F.col("_before").eqNullSafe(F.col("_after")), updated)
    )
    return images.select(*first, *keys, F.explode(changes).alias("c")).select(*first, "c.change", *keys, "c.image.*")


def _bucketed(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def create_feature_table(
    df: DataFrame, name: str, keys: Sequence[str], schema: StructType | None = None, buckets: int = 64
) -> None:
    """Cast to the declared schema, check the key, and write the table split by key bucket.

    More buckets make a merge rewrite less; the number is kept with the table.
    """
    typed = df if schema is None else df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    check_keys(typed, keys)
    save_table(_bucketed(typed, keys, buckets), name, partition_by=[BUCKET], audit=False)
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{_BUCKETS}' = '{buckets}', '{_KEYS}' = '{','.join(keys)}')")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def read_feature_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(BUCKET)


def merge_into(
    spark: SparkSession, name: str, updates: DataFrame, keys: Sequence[str], order: Sequence[str] = ()
) -> None:
    """Upsert into a stored feature table, rewriting only the key buckets that the updates touch.

    Columns that only the updates have are added to the table.
    """
    stated = _properties(spark, name)
    if stated[_KEYS] != ",".join(keys):
        raise ValueError(f"the key of {name} is {stated[_KEYS]}")
    schema = spark.table(name).schema
    known_types = [f.name for f in schema if f.name in updates.columns]
    one_each = latest_per_key(_complete(_typed(updates, schema, known_types), keys), keys, order)
    latest = materialize(_bucketed(one_each, keys, int(stated[_BUCKETS])), "updates")
    # At most as many values as the table has buckets.
    touched = [r[0] for r in latest.select(BUCKET).distinct().collect()]
    if not touched:
        return
    known = spark.table(name).columns
    added = [f"`{f.name}` {f.dataType.simpleString()}" for f in latest.schema if f.name not in known]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
    stored = spark.table(name)
    current = stored.where(F.col(BUCKET).isin(touched))
    # The write goes to a staging folder, so the buckets it replaces can be read meanwhile.
    merged = upsert(current, latest, [*keys, BUCKET]).select(*stored.columns)
    insert_by_name(merged.hint("rebalance", BUCKET), name, overwrite=True)
