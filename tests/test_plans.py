"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import FOLDER, plan_of
from pyspark.sql import functions as F

from __spark_entry__ import queries
from larkspur.operators import splits
from larkspur.operators.joins import Lookup, training_set
from larkspur.operators.monitor import profile

PLAIN = [
    "feature_lookup",
    "feature_lookup_two_tables",
    "as_of_lookup",
    "attach_label",
    "quality_profile",
    "random_split",
    "stratified_split",
    "cross_validation_folds",
    "over_sample",
    "under_sample",
    "synthetic_rows",
    "curve_areas_per_group",
    "threshold_sweep",
    "confusion_matrix",
    "metrics_with_areas",
    "upsert",
    "change_feed",
    "label_encode",
    "nearest_neighbours",
    "smote",
]


@pytest.mark.parametrize("name", PLAIN)
def test_no_cross_join_and_no_row_at_a_time_python(spark, name):
    plan = plan_of(queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan


def test_one_join_for_all_features_of_a_table(t):
    # Each lookup reads the table anew.
    lookups = [Lookup(t.customer, [c], ["c_custkey"], ["o_custkey"]) for c in ("c_acctbal", "c_mktsegment", "c_name")]
    plan = training_set(t.orders, lookups)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"Join LeftOuter", plan)) == 1


def test_only_needed_columns_are_read(t):
    plan = plan_of(training_set(t.orders.select("o_orderkey", "o_custkey"), [Lookup(t.customer, ["c_acctbal"], ["c_custkey"], ["o_custkey"])]))
    assert "ReadSchema: struct<c_custkey:bigint,c_acctbal:double>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_rows_without_label_are_dropped_by_an_inner_join(spark):
    plan = queries()["label_predictions"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan
    assert "LeftOuter" not in plan


def test_filters_reach_the_scan(t):
    train, _ = splits.random_split(t.orders, ["o_orderkey"])
    plan = plan_of(train.where(F.col("o_totalprice") > 400_000))
    assert "GreaterThan(o_totalprice,400000.0)" in plan


def test_a_split_moves_no_rows(t):
    train, test = splits.random_split(t.orders, ["o_orderkey"])
    for part in (train, test):
        assert "Exchange" not in plan_of(part)


def test_profile_is_one_aggregation(t):
    rows = t.events.select(
        "ts", "value", F.lit("m").alias("model_name"), F.lit(1.0).alias("status"), F.lit(1.0).alias("prediction")
    )
    plan = plan_of(profile(rows, time="ts", numeric=["value"]))
    # The adaptive plan is printed twice, as run and as first planned.
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1


def test_the_source_is_read_once_for_both_parts(spark, tmp_path):
    """The split counts and filters the prepared rows; neither part goes back to the CSV."""
    from larkspur.plans.inputs import SPEC, sales_text
    from larkspur.plans.preparation import prepare_and_split
    from larkspur.plans.registry import Tables

    text = sales_text(Tables(spark, FOLDER))
    text.write.csv(str(tmp_path / "sales"), header=True)
    raw = spark.read.csv(str(tmp_path / "sales"), header=True, schema=text.schema)
    train, test = prepare_and_split(raw, SPEC)
    for part in (train, test):
        assert "csv" not in plan_of(part).lower()
    assert train.count() + test.count() == raw.count()


def test_running_totals_shuffle_once(t):
    from larkspur.operators.ordering import running_totals

    counted = t.lineitem.groupBy("l_quantity").agg(F.count("*").alias("n"))
    plan = plan_of(running_totals(counted, ["l_quantity"], {"through": "n"}))
    # The only other exchange is that of one row per slice.
    assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning") == 1 and "hashpartitioning(_slice" in plan
