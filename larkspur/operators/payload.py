"""Inference logs: JSON requests and responses to one row per scored record, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField, StructType

from larkspur.functions.columns import from_epoch_millis

# Field names of the log format.
RECORDS = "dataframe_records"
PREDICTIONS = "predictions"
REQUEST_ID = "databricks_request_id"

RESPONSE = StructType(
    [
        StructField(PREDICTIONS, ArrayType(DoubleType())),
        StructField(
            "databricks_output", StructType([StructField("trace", StringType()), StructField(REQUEST_ID, StringType())])
        ),
    ]
)


def request_type(record: StructType) -> StructType:
    return StructType([StructField(RECORDS, ArrayType(record))])


def parse(df: DataFrame, record: StructType) -> DataFrame:
    """Add ``parsed_request`` and ``parsed_response``; malformed text gives null fields."""
    return df.withColumns(
        {
            "parsed_request": F.from_json("request", request_type(record)),
            "parsed_response": F.from_json("response", RESPONSE),
        }
    )


def explode_records(df: DataFrame) -> DataFrame:
    """One row per record with its position; a request without records gives none."""
    return df.select("*", F.posexplode(f"parsed_request.{RECORDS}").alias("position", "record"))


def prediction_at(position: Column) -> Column:
    """The prediction of the record at a position; null when the response is shorter."""
    return F.get(F.col(f"parsed_response.{PREDICTIONS}"), position)


def flatten(df: DataFrame, record: StructType, fields: Mapping[str, str], model: str) -> DataFrame:
    """One row per record of each logged request.

    ``fields`` maps record fields to output columns. Record i gets prediction i. A projection and an explode: no shuffle.
    """
    return df.transform(parse, record).transform(explode_records).select(
        from_epoch_millis(F.col("timestamp_ms")).alias("timestamp"),
        "timestamp_ms",
        REQUEST_ID,
        "execution_time_ms",
        "position",
        *[F.col(f"record.{f}").alias(name) for f, name in fields.items()],
        prediction_at(F.col("position")).alias("prediction"),
        F.lit(model).alias("model_name"),
    )


def to_requests(df: DataFrame, columns: Sequence[str], request: Sequence[str] = (), order: Sequence[str] = ()) -> DataFrame:
    """Request bodies as JSON: one per row, or one per value of ``request`` with the records in ``order``.

    ``request`` must name small batches; a batch is held in one task.
    """
    record = F.struct(*columns)
    if not request:
        return df.select(F.to_json(F.struct(F.array(record).alias(RECORDS))).alias("request"))
    ordered = F.array_sort(F.collect_list(F.struct(F.struct(*order).alias("o"), record.alias("r"))))
    return df.groupBy(*request).agg(
        F.to_json(F.struct(F.transform(ordered, lambda x: x["r"]).alias(RECORDS))).alias("request")
    )
