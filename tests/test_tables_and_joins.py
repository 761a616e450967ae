"""Table management, feature tables, lookups and point-in-time joins."""

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larkspur.functions.hashing import row_hash
from larkspur.operators import feature_table, tables
from larkspur.operators.joins import Lookup, as_of_join, attach_label, fuse, training_set
from larkspur.workspace import scratch_database


def test_modes(spark):
    name = f"{scratch_database(spark)}.t"
    rows = spark.range(3)
    tables.save_table(rows, name, "error", audit=False)
    with pytest.raises(PySparkException):
        tables.save_table(rows, name, "error", audit=False)
    tables.save_table(rows, name, "ignore", audit=False)
    assert spark.table(name).count() == 3
    tables.save_table(rows, name, "append", audit=False)
    assert spark.table(name).count() == 6


def test_columns_must_match(spark):
    name = f"{scratch_database(spark)}.t"
    tables.save_table(spark.range(3), name, audit=False)
    with pytest.raises(ValueError, match="columns differ"):
        tables.insert_by_name(spark.range(3).withColumn("x", F.lit(1)), name)


def test_overwrite_of_a_partitioned_table_replaces_all(spark):
    name = f"{scratch_database(spark)}.t"
    for value in ("a", "b"):
        tables.save_table(spark.range(3).withColumn("p", F.lit(value)), name, partition_by=["p"], audit=False)
    assert [r["p"] for r in spark.table(name).select("p").distinct().collect()] == ["b"]


def test_drop_absent_table(spark):
    name = f"{scratch_database(spark)}.none"
    assert tables.drop_table(spark, name) is False
    with pytest.raises(PySparkException):
        tables.drop_table(spark, name, if_exists=False)


def test_key_is_checked(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    got = {(r["k"], r["occurrences"], r["has_null"]) for r in feature_table.key_violations(rows, ["k"]).collect()}
    assert got == {(1, 2, False), (None, 1, True)}
    with pytest.raises(ValueError, match="repeats"):
        feature_table.create_feature_table(rows, f"{scratch_database(spark)}.f", ["k"])


def test_upsert_takes_the_latest_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, x double")
    updates = spark.createDataFrame([(2, 5.0, 1), (2, 9.0, 2), (3, 7.0, 1)], "k int, x double, at int")
    once = feature_table.upsert(target, updates, ["k"], ["at"])
    assert sorted(map(tuple, once.select("k", "name", "x").collect())) == [(1, "a", 1.0), (2, "b", 9.0), (3, None, 7.0)]
    twice = feature_table.upsert(once, updates, ["k"], ["at"])
    assert sorted(map(tuple, twice.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_an_updated_null_replaces_a_value(spark):
    target = spark.createDataFrame([(1, 1.0)], "k int, x double")
    updates = spark.createDataFrame([(1, None)], "k int, x double")
    assert feature_table.upsert(target, updates, ["k"]).first()["x"] is None


def test_merge_rewrites_only_touched_buckets(spark):
    name = f"{scratch_database(spark)}.f"
    rows = spark.range(100).withColumn("x", F.lit(0))
    feature_table.create_feature_table(rows, name, ["id"], buckets=8)
    files = {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}
    feature_table.merge_into(spark, name, spark.range(1).withColumn("x", F.lit(1)), ["id"])
    kept = {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()} & files
    assert len(kept) == len(files) - 1
    got = feature_table.read_feature_table(spark, name)
    assert got.count() == 100
    assert got.where("x = 1").count() == 1


def test_merge_adds_new_columns_and_knows_its_key(spark):
    name = f"{scratch_database(spark)}.f"
    feature_table.create_feature_table(spark.range(10).withColumn("x", F.lit(0)), name, ["id"], buckets=4)
    feature_table.merge_into(spark, name, spark.range(8, 12).withColumn("y", F.lit("new")), ["id"])
    got = {r["id"]: (r["x"], r["y"]) for r in feature_table.read_feature_table(spark, name).collect()}
    assert got == {**{i: (0, None) for i in range(8)}, 8: (0, "new"), 9: (0, "new"), 10: (None, "new"), 11: (None, "new")}
    with pytest.raises(ValueError, match="key of"):
        feature_table.merge_into(spark, name, spark.range(1).withColumn("x", F.lit(1)), ["x"])


def test_change_feed_sees_nulls(spark):
    old = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(1, None), (2, None), (4, "d")], "k int, v string")
    got = sorted(map(tuple, feature_table.change_feed(old, new, ["k"]).collect()), key=str)
    assert got == sorted(
        [("update_preimage", 2, "b"), ("update_postimage", 2, None), ("delete", 3, "c"), ("insert", 4, "d")], key=str
    )


def test_lookups_are_fused(spark):
    features = spark.range(3).withColumns({"a": F.lit(1), "b": F.lit(2)})
    (one,) = fuse([Lookup(features, ["a"], ["id"]), Lookup(features, ["b"], ["id"])])
    assert one.features == ["a", "b"]
    with pytest.raises(ValueError, match="already in the base rows"):
        training_set(features, [Lookup(features, ["a"], ["id"])])


def test_lookup_keeps_base_rows(spark):
    base = spark.createDataFrame([(1, 0), (1, 1), (9, 0)], "id long, y int")
    features = spark.range(3).withColumn("a", F.col("id") * 10)
    got = sorted(map(tuple, training_set(base, [Lookup(features, ["a"], ["id"])], label="y").collect()))
    assert got == [(1, 10, 0), (1, 10, 1), (9, None, 0)]


def test_labels_do_not_multiply_rows(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (3,)], "k int")
    first = spark.createDataFrame([(1, 5), (1, 5), (2, None)], "k int, y int")
    second = spark.createDataFrame([(1, 7), (2, 8)], "k int, y int")
    got = sorted(map(tuple, attach_label(rows, [first, second], "k", "y").collect()))
    assert got == [(1, 5), (1, 5), (2, 8), (3, None)]


@pytest.mark.parametrize("hot_rows", [1_000_000, 20])
def test_as_of_join_against_pandas(spark, hot_rows):
    """One key holds a third of all rows; cut into pieces or not, the result is the same."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40)
    moment = F.timestamp_seconds(F.xxhash64("id") % 5_000 + 10_000)
    rows = spark.range(900).select(key.alias("k"), moment.alias("at"), F.col("id"))
    features = rows.where("id % 2 = 0").select("k", F.col("at").alias("seen"), F.col("id").alias("x"))
    base = rows.where("id % 2 = 1")
    odd = spark.createDataFrame([(None, None, -1), (0, None, -2)], "k long, at timestamp, id long")
    got = as_of_join(base.unionByName(odd), features, ["k"], "at", "seen", ["x"], hot_rows=hot_rows)
    left = base.toPandas().sort_values("at")
    right = features.toPandas().sort_values(["seen", "x"])
    want = pd.merge_asof(left, right, left_on="at", right_on="seen", by="k")
    expected = {r.id: None if pd.isna(r.x) else int(r.x) for r in want.itertuples()}
    expected.update({-1: None, -2: None})
    assert {r["id"]: r["x"] for r in got.collect()} == expected


def test_merge_with_a_narrower_key_and_null_keys(spark):
    name = f"{scratch_database(spark)}.keyed"
    feature_table.create_feature_table(spark.range(10).select("id", F.lit(1).alias("x")), name, ["id"], buckets=4)
    narrow = spark.range(10).select(F.col("id").cast("int").alias("id"), F.lit(2).alias("x"))
    feature_table.merge_into(spark, name, narrow, ["id"])
    rows = feature_table.read_feature_table(spark, name)
    assert (rows.count(), rows.agg(F.sum("x")).first()[0]) == (10, 20)
    empty = spark.createDataFrame([(None, 5)], "id int, x int")
    with pytest.raises(PySparkException, match="null in the key"):
        feature_table.merge_into(spark, name, empty, ["id"])
    with pytest.raises(PySparkException, match="null in the key"):
        feature_table.upsert(rows, empty, ["id"]).collect()


def test_composite_keys_hash_apart(spark):
    rows = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), ("a", None), (None, "a"), ("a", "")], "x string, y string")
    assert rows.select(row_hash(["x", "y"], 1).alias("h")).distinct().count() == 5


def test_many_hot_keys_are_cut_by_their_own_times(spark):
    """Twenty keys in time ranges of their own: each is cut, none shares the cuts of another."""
    from larkspur.operators.joins import _in_pieces

    rows = spark.range(4_000).select(
        (F.col("id") % 20).alias("k"),
        F.timestamp_seconds((F.col("id") % 20) * 1_000_000 + F.col("id")).alias("_time"),
        F.lit(0).alias("_kind"),
        F.struct(F.col("id").alias("_at")).alias("_feature"),
        F.lit(None).cast("struct<x:int>").alias("_base"),
        F.lit(0.0).alias("_piece"),
    )
    hot = rows.select("k").distinct()
    got = _in_pieces(rows.withColumn("_feature", F.struct(F.col("_time").alias("_at"))), ["k"], hot, 17)
    largest = got.groupBy("k", "_piece").count().agg(F.max("count")).first()[0]
    assert largest <= 50


def test_one_hot_moment_is_not_one_group(spark):
    """A key whose rows share one time, others with a few hot times: right answers, and no group above the limit."""
    import random

    from larkspur.operators import joins

    pick = random.Random(3)
    times = ["2024-01-01 00:00:00"] * 300 + [f"2024-01-01 00:{pick.randrange(60):02d}:00" for _ in range(200)]
    base = [("hot" if i < 300 else pick.choice(["b", "c"]), at, i) for i, at in enumerate(times)]
    seen = [("hot", "2024-01-01 00:00:00", k % 7) for k in range(400)] + [("hot", "2023-12-31 00:00:00", 99), ("hot", "2024-01-02 00:00:00", 98)]
    seen += [("b", f"2024-01-01 00:{pick.randrange(60):02d}:00", k) for k in range(80)]
    rows = spark.createDataFrame(base, "k string, at string, i int").withColumn("at", F.col("at").cast("timestamp"))
    features = spark.createDataFrame(seen, "k string, seen string, x int").withColumn("seen", F.col("seen").cast("timestamp"))
    want = {}
    for k, at, i in base:
        known = [(s, x) for o, s, x in seen if o == k and s <= at]
        want[i] = max(known)[1] if known else None
    got = as_of_join(rows, features, ["k"], "at", "seen", ["x"], hot_rows=50).collect()
    assert {r["i"]: r["x"] for r in got} == want and len(got) == len(base)

    side = features.select("k", F.col("seen").alias("_time"), F.lit(0).alias("_kind"), F.struct(F.col("seen").alias("_at"), "x").alias("_feature"))
    asked = rows.select("k", F.col("at").alias("_time"), F.lit(1).alias("_kind"), F.struct("i").alias("_base"))
    hot, n, largest = joins.hot_keys(side.select("k").union(asked.select("k")), ["k"], 50)
    assert n == 3 and largest == 702
    groups = joins._hot_moments(side, asked, ["k"], hot, 50).groupBy("k", "_piece").count()
    assert groups.agg(F.max("count")).first()[0] <= 50
