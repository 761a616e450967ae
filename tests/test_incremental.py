"""State that refreshes add to: counts that merge, files read once, labels that come late, refreshes that die."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from larkspur.operators import monitor
from larkspur.operators.payload import REQUEST_ID, flatten
from larkspur.operators.profiles import merged, observation_counts, profile_of
from larkspur.operators.quality_store import QualityStore
from larkspur.plans.inputs import FIELDS, MODEL, RECORD, label_sources, payload
from larkspur.streaming.inference import append_available, labelled_stream, payload_stream, profile_stream
from larkspur.workspace import materialize

ROW_KEY = [REQUEST_ID, "position"]
EXACT = ["window_start", "rows", "value_nulls", "value_min", "value_max", "value_median", "accuracy_score", "f1_score_weighted"]
CLOSE = ["value_mean", "value_stddev", "mse", "rmse", "mae", "r2"]


def same_profile(got, want):
    a, b = (sorted((r.asDict() for r in df.collect()), key=lambda r: r["window_start"]) for df in (got, want))
    assert [[r[c] for c in EXACT] for r in a] == [[r[c] for c in EXACT] for r in b] and a
    for x, y in zip(a, b, strict=True):
        for c in CLOSE:
            assert x[c] == y[c] or abs(x[c] - y[c]) < 1e-9 * max(1, abs(y[c]))


@pytest.fixture
def labelled(t):
    flat = flatten(payload(t), RECORD, FIELDS, MODEL)
    return monitor.label_predictions(flat, label_sources(t), "event_id", "status")


def test_counts_of_parts_add_up(labelled):
    def counts(rows):
        return observation_counts(rows, "timestamp", "model_name", "status", "prediction", ["value"], "30 minutes")

    rows = materialize(labelled.withColumn("value", F.when(F.col("event_id") % 9 != 0, F.col("value"))), "rows")
    parts = [counts(rows.where(F.col("event_id") % 3 == k)) for k in range(3)]
    assert sorted(map(str, merged(*parts).collect())) == sorted(map(str, counts(rows).collect()))
    same_profile(profile_of(materialize(merged(*parts), "counts"), ["value"]), monitor.profile(rows, numeric=["value"]))


@pytest.mark.parametrize("hot", [5_000_000, 1])
def test_profile_against_plain_numbers(spark, monkeypatch, hot):
    monkeypatch.setattr("larkspur.operators.profiles.HOT_VALUES", hot)
    at, late = datetime(2024, 1, 1, 0, 5), datetime(2024, 1, 1, 0, 35)
    rows = [(at, 1.0, 1.0, 5), (at, 0.0, 1.0, None), (at, 0.0, 0.0, 7), (at, 0.0, 0.0, 7), (late, 1.0, 0.0, None)]
    df = spark.createDataFrame(rows, "timestamp timestamp, status double, prediction double, value int")
    df = df.withColumn("model_name", F.lit("m"))
    first, second = (r.asDict() for r in monitor.profile(df, numeric=["value"]).orderBy("window_start").collect())
    assert (first["rows"], first["value_nulls"], first["value_min"], first["value_max"], first["value_median"]) == (4, 1, 5, 7, 7)
    assert first["value_mean"] == pytest.approx(19 / 3) and first["value_stddev"] == pytest.approx((4 / 3) ** 0.5)
    # Class 1: one of one found with one false alarm; class 0: two of three found.
    assert first["f1_score_weighted"] == pytest.approx((2 / 3 + 3 * 0.8) / 4) and first["accuracy_score"] == 0.75
    assert first["mse"] == 0.25 and first["r2"] == pytest.approx(1 - 1 / 0.75)
    assert second["value_median"] is None and second["value_stddev"] is None and second["r2"] is None and second["value_nulls"] == 1


@pytest.fixture
def store(spark, tmp_path):
    return QualityStore(
        spark, str(tmp_path / "store"), lambda rows: flatten(rows, RECORD, FIELDS, MODEL), ROW_KEY, "event_id", "status",
        {"value": "double"},
    )


def test_refreshes_read_new_files_alone(spark, t, store, labelled, tmp_path, monkeypatch):
    log, path, labels = payload(t), str(tmp_path / "log"), label_sources(t)
    part = F.abs(F.xxhash64(REQUEST_ID)) % 3
    log.where(part == 0).repartition(2).write.parquet(path)
    assert store.refresh(path, log.schema, [labels[0].where("false")]) == 1
    assert store.rows().count() == 0 and store.waiting() > 0 and store.state()["files_read"] == 2
    # Requests of the first part are delivered again together with those of the second.
    log.where(part <= 1).coalesce(1).write.mode("append").parquet(path)

    def dies(*_args):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(QualityStore, "_publish", dies)
        with pytest.raises(OSError, match="lost"):
            store.refresh(path, log.schema, labels)
    assert store.state()["version"] == 1 and store.rows().count() == 0
    assert store.refresh(path, log.schema, labels) == 2 and store.state()["files_read"] == 1
    assert store.compact() == 3 and len(store.state()["counts"]) == 1
    log.where(part == 2).coalesce(1).write.mode("append").parquet(path)
    log.where(part == 1).coalesce(1).write.mode("append").parquet(path)  # late files with known rows
    assert store.refresh(path, log.schema, labels) == 4 and store.state()["files_read"] == 2
    assert store.refresh(path, log.schema, labels) == 5 and store.state()["files_read"] == 0
    names = [*ROW_KEY, "event_id", "status", "prediction"]
    assert sorted(map(str, store.rows().select(names).collect())) == sorted(map(str, labelled.select(names).collect()))
    same_profile(store.profile(), monitor.profile(labelled, numeric=["value"]))
    # Errors never get a prediction and don't wait; only unlabelled predictions do.
    assert store.waiting() == flatten(log, RECORD, FIELDS, MODEL).where("prediction is not null").count() - labelled.count()


def test_a_label_one_batch_later_is_counted(spark, tmp_path):
    log, known, out, state = (str(tmp_path / n) for n in ("log", "labels", "out", "state"))
    noon = datetime(2024, 1, 1, 12)
    rows = "event_id long, timestamp timestamp, model_name string, prediction double"
    label = "event_id long, status int, labelled_at timestamp"

    def deliver(records, labels):
        for data, schema, path in ((records, rows, log), (labels, label, known)):
            spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
        left, right = (payload_stream(spark, p, spark.createDataFrame([], s).schema) for p, s in ((log, rows), (known, label)))
        joined = labelled_stream(left, right, "event_id", "status", "2 days")
        append_available(profile_stream(joined.where("status is not null")), out, state)
        return sorted((r["rows"], r["accuracy_score"]) for r in spark.read.schema("rows long, accuracy_score double").parquet(out).collect())

    hour = timedelta(hours=1)
    first = [(k, noon + k * timedelta(minutes=1), "m", 1.0) for k in range(4)]
    assert deliver(first, [(0, 1, noon + hour), (1, 0, noon + hour)]) == []
    # Labels of 2 come a batch later, once repeated; 3 never gets one; the label of 1 comes again and doesn't count.
    assert deliver([(9, noon + 20 * hour, "m", 1.0)], [(2, 1, noon + 20 * hour), (2, 0, noon + 20.5 * hour), (1, 1, noon + 20 * hour)]) == []
    done = deliver([(99, noon + 900 * hour, "m", 1.0)], [(99, 1, noon + 901 * hour)])
    assert done == [(3, pytest.approx(2 / 3))]


def test_records_without_a_label_come_out_in_the_end(spark, tmp_path):
    log, known, out, state = (str(tmp_path / n) for n in ("log", "labels", "out", "state"))
    noon, far = datetime(2024, 1, 1, 12), datetime(2024, 3, 1)
    for records, labels in (([(1, noon), (2, noon)], [(1, 1, noon)]), ([(3, far)], [(3, 1, far)])):
        rows = spark.createDataFrame([(k, at, 1.0) for k, at in records], "event_id long, timestamp timestamp, prediction double")
        marks = spark.createDataFrame(labels, "event_id long, status int, labelled_at timestamp")
        rows.write.mode("append").parquet(log)
        marks.write.mode("append").parquet(known)
        joined = labelled_stream(
            payload_stream(spark, log, rows.schema), payload_stream(spark, known, marks.schema), "event_id", "status", "1 day"
        )
        append_available(joined, out, state)
    assert sorted((r["event_id"], r["status"]) for r in spark.read.parquet(out).collect() if r["event_id"] < 3) == [(1, 1.0), (2, None)]
