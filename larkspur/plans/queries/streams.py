"""The incremental jobs as streams over a log folder, read file by file."""

from pyspark.sql import functions as F

from larkspur.operators.joins import attach_label
from larkspur.operators.monitor import label_predictions
from larkspur.operators.payload import flatten
from larkspur.operators.profiles import profile_of
from larkspur.plans.inputs import FIELDS, FLAT, MODEL, RECORD, label_sources, payload
from larkspur.plans.queries.monitoring import PROFILE
from larkspur.plans.registry import query
from larkspur.streaming.inference import (
    append_available, count_stream, flatten_stream, labelled_stream, payload_stream, profile_stream,
)
from larkspur.workspace import materialize, new_path


def _log_folder(t) -> tuple[str, object]:
    """The log as a few files."""
    path = new_path(t.spark, "log")
    log = payload(t)
    log.write.parquet(path)
    return path, log.schema


@query("stream_flatten", f"WITH {FLAT} SELECT * EXCLUDE (event_type) FROM flat")
def _(t):
    """The log is delivered twice to one stream run; every record comes out once."""
    path, schema = _log_folder(t)
    out = new_path(t.spark, "flat")
    stream = payload_stream(t.spark, path, schema)
    doubled = stream.unionByName(payload_stream(t.spark, path, schema))
    append_available(flatten_stream(doubled, RECORD, FIELDS, MODEL), out, new_path(t.spark, "state"))
    rows = t.spark.read.parquet(out)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(
    "stream_event_profile",
    """WITH counted AS (
         SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS window_start,
                time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS window_end, event_type AS model_name,
                count(*) AS rows, round(avg(value), 9) AS value_mean, max(value) AS value_max,
                round(count_if((value > 20) = (value > 10)) / count(*), 6) AS accuracy_score
         FROM events GROUP BY ALL)
       SELECT * FROM counted WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def _(t):
    """The 30-minute profile as a stream, run twice on a growing folder.

    What it wrote equals the batch profile of all windows it has closed.
    """
    path, out, state = (new_path(t.spark, label) for label in ("events", "profile", "state"))
    events = t.events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("model_name"),
        "value",
        (F.col("value") > 20).cast("double").alias("status"),
        (F.col("value") > 10).cast("double").alias("prediction"),
    )
    early = F.col("timestamp") < F.lit("2024-01-16").cast("timestamp")
    for arrived in (events.where(early), events.where(~early)):
        arrived.write.mode("append").parquet(path)
        stream = payload_stream(t.spark, path, events.schema)
        append_available(profile_stream(stream, numeric=["value"]), out, state)
    return t.spark.read.parquet(out).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "model_name",
        "rows",
        F.round("value_mean", 9).alias("value_mean"),
        "value_max",
        F.round("accuracy_score", 6).alias("accuracy_score"),
    )


@query(
    "stream_quality_profile",
    f"""WITH {PROFILE} SELECT window_start, window_end, model_name, rows, value_max, value_median AS value_median_approx,
              round(accuracy_score, 6) AS accuracy_score, round(f1_score_weighted, 6) AS f1_score_weighted FROM profile
        WHERE window_end <= (SELECT max(timestamp) FROM flat) - INTERVAL 1 HOUR""",
)
def _(t):
    """From logged JSON to the quality of each closed window: one stream of exact counts, whose profile is taken in batch.

    The labels are static tables.
    """
    path, schema = _log_folder(t)
    flat = flatten_stream(payload_stream(t.spark, path, schema), RECORD, FIELDS, MODEL)
    labelled = label_predictions(flat, label_sources(t), "event_id", "status")
    out = new_path(t.spark, "counts")
    append_available(count_stream(labelled, numeric=["value"]), out, new_path(t.spark, "state"))
    return profile_of(t.spark.read.parquet(out), ["value"]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "model_name",
        "rows",
        "value_max",
        F.col("value_median").alias("value_median_approx"),
        F.round("accuracy_score", 6).alias("accuracy_score"),
        F.round("f1_score_weighted", 6).alias("f1_score_weighted"),
    )


def timed_labels(t, flat):
    """The label of each record with the time it is known: ten minutes after the record, ten days for every third."""
    known = attach_label(flat.select("event_id", "timestamp"), label_sources(t), "event_id", "status")
    after = F.when(F.col("event_id") % 3 == 0, F.expr("INTERVAL 10 DAYS")).otherwise(F.expr("INTERVAL 10 MINUTES"))
    return known.where("status IS NOT NULL").select("event_id", "status", (F.col("timestamp") + after).alias("labelled_at"))


@query(
    "stream_late_labels",
    f"""WITH {PROFILE} SELECT window_start, window_end, model_name, rows, value_max,
              round(accuracy_score, 6) AS accuracy_score, round(f1_score_weighted, 6) AS f1_score_weighted FROM profile""",
)
def _(t):
    """Log and labels both as streams, delivered in three parts by their own times; every third label comes days after its
    record, in a later run. A last record of the far future on both sides closes all windows before it."""
    log = materialize(payload(t), "payload")
    labels = materialize(timed_labels(t, flatten(log, RECORD, FIELDS, MODEL)), "labels")
    paths = [new_path(t.spark, name) for name in ("log", "labels", "profile", "state")]
    edges = ["1970-01-01", "2024-01-11", "2024-01-21", "2200-01-01"]
    far = F.expr("INTERVAL 3650 DAYS")
    seconds = 3650 * 86_400_000
    ends = (
        log.orderBy("timestamp_ms").limit(1).withColumn("timestamp_ms", F.col("timestamp_ms") + seconds),
        labels.orderBy("labelled_at").limit(1).withColumn("labelled_at", F.col("labelled_at") + far),
    )
    times = (F.timestamp_millis("timestamp_ms"), F.col("labelled_at"))
    for first, last in [*zip(edges, edges[1:], strict=False), (None, None)]:
        for path, table, at, end in zip(paths, (log, labels), times, ends, strict=False):
            part = table.where((at >= F.lit(first).cast("timestamp")) & (at < F.lit(last).cast("timestamp"))) if first else end
            part.write.mode("append").parquet(path)
        flat = flatten_stream(payload_stream(t.spark, paths[0], log.schema), RECORD, FIELDS, MODEL)
        known = payload_stream(t.spark, paths[1], labels.schema)
        joined = labelled_stream(flat, known, "event_id", "status", "11 days")
        counted = joined.where("status IS NOT NULL AND prediction IS NOT NULL")
        append_available(profile_stream(counted, numeric=["value"]), paths[2], paths[3])
    return t.spark.read.parquet(paths[2]).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        "model_name",
        "rows",
        "value_max",
        F.round("accuracy_score", 6).alias("accuracy_score"),
        F.round("f1_score_weighted", 6).alias("f1_score_weighted"),
    )
