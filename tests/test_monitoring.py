"""Inference log to alert, in batch and as a stream."""

import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larkspur.operators import monitor, payload
from larkspur.plans import booking, monitoring
from larkspur.operators.profiles import profile_of
from larkspur.streaming.inference import (
    append_available, closed_windows, count_stream, flatten_stream, payload_stream, profile_stream,
)
from larkspur.workspace import new_path, scratch_database

BASE = 1_700_000_000_000
LOG = "timestamp_ms long, databricks_request_id string, execution_time_ms long, request string, response string"


def _request(*keys):
    records = [{booking.KEY: k, "no_of_adults": 2, "arrival_year": 2018, "avg_price_per_room": 99.5} for k in keys]
    return json.dumps({"dataframe_records": records})


@pytest.fixture
def log(spark):
    rows = [
        (BASE, "r1", 5, _request("a", "b"), '{"predictions": [1.0, 0.0]}'),
        (BASE + 1_500, "r2", 5, _request("c"), '{"predictions": [1.0]}'),
        (BASE + 2_000, "r3", 5, "not json", '{"predictions": [1.0]}'),
        (BASE + 3_000, "r4", 5, _request("d"), "upstream timeout"),
        (BASE + 4_000, "r5", 5, _request("e", "f"), '{"predictions": [0.0]}'),
    ]
    return spark.createDataFrame(rows, LOG)


def _flat(log):
    return payload.flatten(log, booking.RECORD, booking.MONITORED, "m")


def test_record_gets_its_own_prediction(log):
    got = {r[booking.KEY]: r["prediction"] for r in _flat(log).collect()}
    assert got == {"a": 1.0, "b": 0.0, "c": 1.0, "d": None, "e": 0.0, "f": None}


def test_projection(log):
    row = _flat(log).where(F.col(booking.KEY) == "c").first()
    assert (row["hotel_arrival_year"], row["no_of_adults"], row["avg_price_per_room"]) == (2018, 2, 99.5)
    assert row["timestamp"].timestamp() * 1_000 == BASE + 1_000
    assert "type_of_meal_plan" not in row.asDict()


def test_refresh_twice_stores_once(spark, log):
    name = f"{scratch_database(spark)}.monitoring"
    labels = [
        spark.createDataFrame([("a", 1), ("b", 1), ("b", 1)], f"{booking.KEY} string, {booking.TARGET} int"),
        spark.createDataFrame([("a", 0), ("c", 1), ("e", 0)], f"{booking.KEY} string, {booking.TARGET} int"),
    ]
    for _ in range(2):
        table = monitoring.refresh(
            spark, log, labels, name, booking.RECORD, booking.MONITORED, "m", booking.KEY, booking.TARGET
        )
    got = sorted((r[booking.KEY], r["status"], r["prediction"]) for r in table.collect())
    assert got == [("a", 1.0, 1.0), ("b", 1.0, 0.0), ("c", 1.0, 1.0), ("e", 0.0, 0.0)]
    profile, alert = monitoring.quality_report(table, ["avg_price_per_room"])
    assert profile.first()["rows"] == 4
    assert profile.first()["accuracy_score"] == 0.75
    assert alert.first()["triggered"] is False


def test_check_names(spark):
    rows = spark.createDataFrame([(0.5,), (0.7,)], "f1_score_weighted double")
    assert monitor.check(rows).first()["triggered"] is True
    assert monitor.check(rows, op="GREATER_THAN").first()["triggered"] is False
    with pytest.raises(ValueError, match="operator"):
        monitor.check(rows, op="ABOUT")


def test_requests_round_trip(spark, log):
    flat = _flat(log).select(booking.KEY, "databricks_request_id", "position")
    bodies = payload.to_requests(flat, [booking.KEY], ["databricks_request_id"], ["position"])
    got = {r["databricks_request_id"]: json.loads(r["request"])["dataframe_records"] for r in bodies.collect()}
    assert got["r1"] == [{booking.KEY: "a"}, {booking.KEY: "b"}]


def test_stream_flatten_equals_batch(spark, log):
    path, out, state = (new_path(spark, n) for n in ("log", "flat", "state"))
    for _ in range(2):
        # The same requests are delivered again before the second run.
        log.write.mode("append").parquet(path)
        stream = flatten_stream(payload_stream(spark, path, log.schema), booking.RECORD, booking.MONITORED, "m")
        append_available(stream, out, state)
    key = (booking.KEY, "prediction")
    assert sorted(map(str, spark.read.parquet(out).select(*key).collect())) == sorted(
        map(str, _flat(log).select(*key).collect())
    )


def test_stream_profile_equals_batch_on_closed_windows(spark, t):
    rows = t.events.select(
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("event_type").alias("model_name"),
        "value",
        (F.col("value") > 20).cast("double").alias("status"),
        (F.col("value") > 10).cast("double").alias("prediction"),
    )
    path, out, state = (new_path(spark, n) for n in ("events", "profile", "state"))
    for day in (1, 11, 21):
        part = rows.where(F.dayofmonth("timestamp").between(day, day + 9 + (day > 20)))
        part.write.mode("append").parquet(path)
        append_available(profile_stream(payload_stream(spark, path, rows.schema), numeric=["value"]), out, state)
    newest = rows.agg(F.max("timestamp")).first()[0]
    batch = closed_windows(monitor.profile(rows, numeric=["value"]), newest)
    names = ["window_start", "model_name", "rows", "value_max", "accuracy_score", "f1_score_weighted"]
    got = sorted(map(tuple, spark.read.parquet(out).select(names).collect()))
    assert got == sorted(map(tuple, batch.select(names).collect()))
    assert 0 < len(got)


def test_stream_counts_give_exact_medians_of_large_windows(spark):
    """More different values in a window than a sketch keeps apart."""
    rows = spark.range(60_000).select(
        F.expr("timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, id DIV 10)").alias("timestamp"),
        F.lit("m").alias("model_name"),
        (F.abs(F.xxhash64("id")) / 1e12).alias("value"),
        (F.col("id") % 2).cast("double").alias("status"),
        (F.col("id") % 3 % 2).cast("double").alias("prediction"),
    )
    path, out, state = (new_path(spark, n) for n in ("events", "counts", "state"))
    for part in (rows.where("id < 40000"), rows.where("id >= 40000")):
        part.write.mode("append").parquet(path)
        append_available(count_stream(payload_stream(spark, path, rows.schema), numeric=["value"]), out, state)
    batch = closed_windows(monitor.profile(rows, numeric=["value"]), rows.agg(F.max("timestamp")).first()[0])
    names = ["window_start", "window_end", "model_name", "rows", "value_min", "value_median", "accuracy_score"]
    got = sorted(map(tuple, profile_of(spark.read.parquet(out), ["value"]).select(names).collect()))
    assert got == sorted(map(tuple, batch.select(names).collect())) and got[0][3] == 18_000


def test_rows_without_a_time_are_stored_once(spark):
    name = f"{scratch_database(spark)}.log"
    rows = spark.createDataFrame(
        [(1, None), (2, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2))], "id int, timestamp timestamp"
    )
    for _ in range(3):
        monitor.append_new(spark, rows, name, ["id"])
    assert sorted((r["id"], r["timestamp"]) for r in spark.table(name).where("id = 2").collect()) == [
        (2, datetime(2024, 1, 2))
    ]
    assert spark.table(name).count() == 2


def test_profile_of_three_classes_and_large_values(spark):
    at = datetime(2024, 1, 1, 0, 5)
    rows = spark.createDataFrame(
        [(at, "m", float(c), float(c), 1e9 + c) for c in (0, 1, 2, 2)],
        "timestamp timestamp, model_name string, status double, prediction double, value double",
    )
    got = monitor.profile(rows, numeric=["value"]).first()
    assert got["f1_score_weighted"] == 1.0 and got["accuracy_score"] == 1.0 and got["value_median"] == 1e9 + 1
    shifted = rows.withColumns({c: F.col(c) + 1e9 for c in ("status", "prediction")})
    assert monitor.profile(shifted).first()["r2"] == 1.0
    with pytest.raises(PySparkException, match="a class other than"):
        monitor.profile(rows, classes=(0.0, 1.0)).collect()


def test_the_median_is_exact(spark):
    at = datetime(2024, 1, 1, 0, 5)
    rows = spark.range(50_000).select(
        F.lit(at).alias("timestamp"), F.lit("m").alias("model_name"), F.lit(1.0).alias("status"),
        F.lit(1.0).alias("prediction"), F.col("id").cast("double").alias("value"),
    )
    assert monitor.profile(rows, numeric=["value"]).first()["value_median"] == 24_999.0


def test_a_stream_keeps_no_more_state_partitions_than_cores(spark):
    """Each batch commits the state of every partition, rows or none."""
    path, out, state = (new_path(spark, name) for name in ("rows", "out", "state"))
    rows = spark.range(100).select(F.timestamp_seconds(F.col("id") + 86_400).alias("timestamp"), "id")
    rows.write.parquet(path)
    asked = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 40)
    try:
        stream = payload_stream(spark, path, rows.schema).withWatermark("timestamp", "1 hour")
        append_available(stream.dropDuplicatesWithinWatermark(["id"]), out, state)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", asked)
    partitions = [p.name for p in (Path(state) / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(partitions) == spark.sparkContext.defaultParallelism
    assert spark.read.parquet(out).count() == 100
