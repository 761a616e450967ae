"""Inference log to monitoring table to profile to alert."""

from pyspark.sql import functions as F

from larkspur.operators import monitor
from larkspur.operators.payload import REQUEST_ID, flatten
from larkspur.plans.inputs import FIELDS, FLAT, LABELLED, MODEL, RECORD, label_sources, payload
from larkspur.operators.quality_store import QualityStore
from larkspur.plans.registry import query
from larkspur.workspace import new_path, scratch_database

ROW_KEY = [REQUEST_ID, "position"]


def _ntz(df, *names):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in names})


def _labelled(t):
    flat = flatten(payload(t), RECORD, FIELDS, MODEL)
    return monitor.label_predictions(flat, label_sources(t), "event_id", "status")


@query("flatten_inference_log", f"WITH {FLAT} SELECT * EXCLUDE (event_type) FROM flat")
def _(t):
    return _ntz(flatten(payload(t), RECORD, FIELDS, MODEL), "timestamp")


@query("label_predictions", f"WITH {LABELLED} SELECT * FROM labelled")
def _(t):
    return _ntz(_labelled(t), "timestamp")


@query("append_new_rows", f"WITH {LABELLED} SELECT *, strftime(timestamp, '%Y-%m-%d') AS event_date FROM labelled")
def _(t):
    """Two refreshes: the first sees the requests of three weeks, the second sees all; nothing is stored twice."""
    name = f"{scratch_database(t.spark)}.monitoring"
    rows = _labelled(t)
    monitor.append_new(t.spark, rows.where(F.col("timestamp") < F.lit("2024-01-22").cast("timestamp")), name, ROW_KEY)
    monitor.append_new(t.spark, rows, name, ROW_KEY)
    return _ntz(t.spark.table(name), "timestamp").withColumn("event_date", F.col("event_date").cast("string"))


PROFILE = f"""{LABELLED}, profile AS (
  SELECT time_bucket(INTERVAL 30 MINUTE, timestamp) AS window_start,
         time_bucket(INTERVAL 30 MINUTE, timestamp) + INTERVAL 30 MINUTE AS window_end, model_name, count(*) AS rows,
         CAST(count_if(value IS NULL) AS BIGINT) AS value_nulls, avg(value) AS value_mean, stddev_samp(value) AS value_stddev,
         min(value) AS value_min, max(value) AS value_max, quantile_disc(value, 0.5) AS value_median,
         avg((prediction - status) ** 2) AS mse, sqrt(avg((prediction - status) ** 2)) AS rmse,
         avg(abs(prediction - status)) AS mae,
         CASE WHEN sum(status * status) - sum(status) * sum(status) / count(*) > 0
              THEN 1 - sum((prediction - status) ** 2) / (sum(status * status) - sum(status) * sum(status) / count(*)) END
         AS r2,
         count_if(status = prediction) / count(*) AS accuracy_score,
         (count_if(status = 1) * CASE WHEN count_if(status = 1) + count_if(prediction = 1) = 0 THEN 0 ELSE
            2 * count_if(status = 1 AND prediction = 1) / (count_if(status = 1) + count_if(prediction = 1)) END
          + count_if(status = 0) * CASE WHEN count_if(status = 0) + count_if(prediction = 0) = 0 THEN 0 ELSE
            2 * count_if(status = 0 AND prediction = 0) / (count_if(status = 0) + count_if(prediction = 0)) END)
         / count(*) AS f1_score_weighted
  FROM labelled GROUP BY ALL)"""
# Means of cents over many row counts end in a five at the sixth digit; nine keep clear of it.
FINE = ("value_mean", "value_stddev")
ROUNDED = (
    "mse",
    "rmse",
    "mae",
    "r2",
    "accuracy_score",
    "f1_score_weighted",
)


def _profile(t):
    return monitor.profile(_labelled(t), numeric=["value"])


@query(
    "quality_profile",
    f"""WITH {PROFILE} SELECT window_start, window_end, model_name, rows, value_nulls, value_min, value_max, value_median,
              {', '.join(f'round({c}, 9) AS {c}' for c in FINE)},
              {', '.join(f'round({c}, 6) AS {c}' for c in ROUNDED)} FROM profile""",
)
def _(t):
    return _ntz(_profile(t), "window_start", "window_end").withColumns(
        {**{c: F.round(c, 9) for c in FINE}, **{c: F.round(c, 6) for c in ROUNDED}}
    )


@query(
    "quality_alert",
    f"""WITH {PROFILE}, mean AS (SELECT avg(f1_score_weighted) * 100.0 AS m FROM profile)
        SELECT round(m, 6) AS avg_f1_score_weighted, CAST(75 AS DOUBLE) AS threshold, m < 75 AS triggered FROM mean""",
)
def _(t):
    return monitor.check(_profile(t)).withColumn("avg_f1_score_weighted", F.round("avg_f1_score_weighted", 6))


def _refreshed(t) -> QualityStore:
    """A store after three refreshes: each finds a third of the log in new files, and more labels than the one before."""
    log, path = payload(t), new_path(t.spark, "log")
    first, second = label_sources(t)
    store = QualityStore(
        t.spark, new_path(t.spark, "quality"), lambda rows: flatten(rows, RECORD, FIELDS, MODEL), ROW_KEY, "event_id",
        "status", {"value": "double"},
    )
    known = [[first.where("event_id % 2 = 0")], [first, second.where("event_id % 2 = 1")], [first, second]]
    for part, labels in enumerate(known):
        log.where(F.abs(F.xxhash64(REQUEST_ID)) % 3 == part).write.mode("append").parquet(path)
        store.refresh(path, log.schema, labels)
    return store


@query(
    "incremental_profile",
    f"""WITH {PROFILE} SELECT window_start, window_end, model_name, rows, value_nulls, value_min, value_max, value_median,
              {', '.join(f'round({c}, 9) AS {c}' for c in FINE)},
              {', '.join(f'round({c}, 6) AS {c}' for c in ROUNDED)} FROM profile""",
)
def _(t):
    """The profile from counts that three refreshes have added up equals the one over the whole log."""
    return _ntz(_refreshed(t).profile(), "window_start", "window_end").withColumns(
        {**{c: F.round(c, 9) for c in FINE}, **{c: F.round(c, 6) for c in ROUNDED}}
    )


@query("incremental_refresh", f"WITH {LABELLED} SELECT *, strftime(timestamp, '%Y-%m-%d') AS event_date FROM labelled")
def _(t):
    """The monitoring table of the same three refreshes: each record once, whenever its label came."""
    return _ntz(_refreshed(t).rows(), "timestamp").withColumn("event_date", F.col("event_date").cast("string"))
