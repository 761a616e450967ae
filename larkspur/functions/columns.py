"""Scalar building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

# Tokens read as null in CSV text.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Declared dtype name -> Spark type.
DTYPES = {
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "int": "int",
    "float32": "float",
    "float64": "double",
    "float": "double",
    "category": "string",
    "object": "string",
    "str": "string",
    "string": "string",
    "bool": "boolean",
    "datetime64[ns]": "timestamp",
}


def spark_type(dtype: str) -> str:
    """Spark type of a declared dtype; Spark type names pass through."""
    return DTYPES.get(dtype, dtype)


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or not a number in a fractional column."""
    col = F.col(column)
    if isinstance(df.schema[column].dataType, FractionalType) and df.schema[column].dataType.typeName() != "decimal":
        return col.isNull() | F.isnan(col)
    return col.isNull()


def present(df: DataFrame, column: str) -> Column:
    """The column; a missing value fails the query."""
    missing = F.raise_error(F.lit(f"missing value in {column}")).cast(df.schema[column].dataType)
    return F.when(is_missing(df, column), missing).otherwise(F.col(column))


def null_if_token(col: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(col.isin(*tokens), F.lit(None)).otherwise(col)


def map_label(col: Column, mapping: Mapping[str, int]) -> Column:
    """Label text to integer; a label outside the mapping, or null, gives null."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.create_map(*pairs)[col.cast("string")].cast("int")


def from_epoch_millis(col: Column) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds."""
    return F.date_trunc("second", F.timestamp_millis(col))


def to_epoch_millis(col: Column) -> Column:
    return F.unix_millis(col.cast("timestamp"))


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives 0 on an empty denominator."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top / bottom)
