"""Streams over an inference log that keeps growing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from larkspur.operators.monitor import WINDOW, profile
from larkspur.operators.payload import REQUEST_ID, flatten
from larkspur.operators.profiles import observations

# How long after its own time a row may still arrive.
LATENESS = "1 hour"


def payload_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """New files of a log folder as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def flatten_stream(
    log: DataFrame, record: StructType, fields: Mapping[str, str], model: str, lateness: str = LATENESS
) -> DataFrame:
    """One row per scored record; a request delivered again within the lateness is dropped."""
    return (
        flatten(log, record, fields, model)
        .withWatermark("timestamp", lateness)
        .dropDuplicatesWithinWatermark([REQUEST_ID, "position"])
    )


def labelled_stream(
    rows: DataFrame,
    labels: DataFrame,
    key: str,
    label: str,
    wait: str,
    time: str = "timestamp",
    labelled_at: str = "labelled_at",
    lateness: str = LATENESS,
) -> DataFrame:
    """Scored records with the label that came for them within ``wait`` of their own time, as ``status``.

    Both sides are streams. A record waits in the state until its label comes, or comes out without one once the watermarks of
    both sides have passed its time and the wait. Of several labels of a key the first counts.
    """
    marked = rows if _has_watermark(rows, time) else rows.withWatermark(time, lateness)
    known = labels.select(
        F.col(key).alias("_key"), F.col(label).cast("double").alias("status"), F.col(labelled_at).alias("_labelled_at")
    )
    known = known.withWatermark("_labelled_at", lateness).dropDuplicatesWithinWatermark(["_key"])
    in_time = (F.col("_labelled_at") >= F.col(time)) & (F.col("_labelled_at") <= F.col(time) + F.expr(f"INTERVAL {wait}"))
    joined = marked.join(known, (F.col(key) == F.col("_key")) & in_time, "left_outer")
    return joined.drop("_key", "_labelled_at").withColumn("prediction", F.col("prediction").cast("double"))


def profile_stream(
    rows: DataFrame,
    time: str = "timestamp",
    numeric: Sequence[str] = (),
    lateness: str = LATENESS,
    every: str = WINDOW,
    classes: Sequence[float] = (0.0, 1.0),
    **columns,
) -> DataFrame:
    """The batch profile as a stream: a window comes out once the watermark has passed its end.

    ``classes`` are the labels there can be; medians are sketches.

    Rows that already carry a watermark keep it.
    """
    marked = rows if _has_watermark(rows, time) else rows.withWatermark(time, lateness)
    return profile(marked, time=time, numeric=numeric, every=every, classes=classes, **columns)


def count_stream(
    rows: DataFrame,
    time: str = "timestamp",
    model: str = "model_name",
    label: str = "status",
    prediction: str = "prediction",
    numeric: Sequence[str] = (),
    lateness: str = LATENESS,
    every: str = WINDOW,
) -> DataFrame:
    """The counts of ``profiles`` as a stream: those of a window come out once the watermark has passed its end.

    ``profile_of`` what was written is the exact profile, medians included, over the classes that occur. The state holds one
    count per window, model and different value, so a window with many rows is spread over all tasks.
    """
    marked = rows if _has_watermark(rows, time) else rows.withWatermark(time, lateness)
    # The window itself carries the watermark.
    counts = observations(marked, time, model, label, prediction, list(numeric), every)
    counts = counts.groupBy("_window", "model_name", "what", "a", "b").agg(F.count("*").alias("n"))
    start, end = F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")
    return counts.select(start, end, "model_name", "what", "a", "b", "n")


def _has_watermark(df: DataFrame, column: str) -> bool:
    field = next(f for f in df.schema if f.name == column)
    return "spark.watermarkDelayMs" in (field.metadata or {})


def append_available(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write everything that has arrived to a Parquet folder, then stop; the checkpoint makes the next run go on.

    A batch opens and commits the state of every partition, rows or none. So a new checkpoint gets one partition for each core,
    if the session asks for more; it keeps their number.
    """
    spark = stream.sparkSession
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    # The stream takes its settings when it starts.
    spark.conf.set("spark.sql.shuffle.partitions", min(int(asked), spark.sparkContext.defaultParallelism))
    try:
        query = (
            stream.writeStream.format("parquet")
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start(path)
        )
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    query.awaitTermination()
    return query


def closed_windows(profile_table: DataFrame, newest, lateness: str = LATENESS) -> DataFrame:
    """The windows of a batch profile that a stream which has seen ``newest`` has finished."""
    limit = F.lit(newest).cast("timestamp") - F.expr(f"INTERVAL {lateness}")
    return profile_table.where(F.col("window_end") <= limit)
