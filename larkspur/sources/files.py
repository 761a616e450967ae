"""CSV scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from larkspur.functions.columns import NULL_TOKENS, null_if_token


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, **options) -> DataFrame:
    """CSV with a header. Without a schema the types are inferred, which costs a scan of its own.

    Options override the defaults ``header=true`` and, when no schema is given, ``inferSchema=true``.
    """
    defaults = {"header": "true"} if schema is not None else {"header": "true", "inferSchema": "true"}
    reader = spark.read.options(**{**defaults, **options})
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_csv_with_null_tokens(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    tokens: Sequence[str] = NULL_TOKENS,
    **options,
) -> DataFrame:
    """CSV where several spellings mean null: read text, drop the tokens, then cast to the declared types.

    Without a schema a scan of its own finds the narrowest type that all remaining values of a column have: whole number,
    number, timestamp or text; a column without values is text.
    """
    if schema is None:
        raw = read_csv(spark, path, inferSchema="false", **options)
        plain = raw.select([null_if_token(F.col(f"`{c}`"), tokens).alias(c) for c in raw.columns])
        return plain.select([F.col(f"`{c}`").cast(kind).alias(c) for c, kind in _found_types(plain).items()])
    text = StructType([StructField(f.name, StringType()) for f in schema])
    raw = read_csv(spark, path, text, **options)
    return raw.select(
        [null_if_token(F.col(f"`{f.name}`"), tokens).cast(f.dataType).alias(f.name) for f in schema]
    )


# Patterns are tested before the cast, so that values of another type cost no exception.
_KINDS = {
    "bigint": r"^\s*[+-]?[0-9]+\s*$",
    "double": r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$",
    "timestamp": r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T].*)?$",
}


def _found_types(text: DataFrame) -> dict[str, str]:
    """The first of the known types that fits all values of each text column, in one aggregation."""
    fits = []
    for i, c in enumerate(text.columns):
        col = F.col(f"`{c}`")
        for kind, pattern in _KINDS.items():
            good = F.when(col.rlike(pattern), col.try_cast(kind).isNotNull()).otherwise(False)
            fits.append(F.count_if(col.isNotNull() & ~good).alias(f"{kind}_{i}"))
        fits.append(F.count(col).alias(f"values_{i}"))
    row = text.agg(*fits).first()
    return {
        c: next((k for k in _KINDS if row[f"values_{i}"] and not row[f"{k}_{i}"]), "string")
        for i, c in enumerate(text.columns)
    }
