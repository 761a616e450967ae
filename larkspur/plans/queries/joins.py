"""Joins, aggregations, unions and top lists."""

from pyspark.sql import functions as F

from larkspur.operators import aggregates
from larkspur.operators.joins import Lookup, as_of_join, attach_label, training_set
from larkspur.plans.inputs import LABELLED, RECORD, FIELDS, MODEL, SALES, SCORED
from larkspur.plans.inputs import label_sources, payload, sales, scored
from larkspur.operators.payload import flatten
from larkspur.plans.registry import query


@query(
    "feature_lookup",
    """WITH features AS (SELECT * FROM customer WHERE c_acctbal >= 0)
       SELECT o_orderkey, o_custkey, c_mktsegment, c_acctbal, c_nationkey, o_orderstatus
       FROM orders LEFT JOIN features ON o_custkey = c_custkey""",
)
def _(t):
    """One lookup per feature, as callers write them; they become one join. Accounts in debt have no features."""
    features = t.customer.where(F.col("c_acctbal") >= 0)
    lookups = [
        Lookup(features, [name], ["c_custkey"], ["o_custkey"]) for name in ("c_mktsegment", "c_acctbal", "c_nationkey")
    ]
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus")
    return training_set(base, lookups, label="o_orderstatus")


@query(
    "feature_lookup_two_tables",
    """SELECT l_orderkey, l_linenumber, p_brand, p_size, s_acctbal, l_returnflag
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def _(t):
    part, supplier = t.part, t.supplier
    base = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    lookups = [
        Lookup(part, ["p_brand"], ["p_partkey"], ["l_partkey"]),
        Lookup(supplier, ["s_acctbal"], ["s_suppkey"], ["l_suppkey"]),
        Lookup(part, ["p_size"], ["p_partkey"], ["l_partkey"]),
    ]
    return training_set(base, lookups, label="l_returnflag", exclude=["l_partkey", "l_suppkey"])


@query(
    "as_of_lookup",
    """WITH views AS (SELECT user_id AS u, ts AS view_ts, value AS view_value FROM events WHERE event_type = 'view')
       SELECT e.event_id, e.user_id, e.ts, v.view_ts, v.view_value
       FROM (SELECT * FROM events WHERE event_type = 'purchase') e
       ASOF LEFT JOIN views v ON e.user_id = v.u AND e.ts >= v.view_ts""",
)
def _(t):
    views = t.events.where("event_type = 'view'").select(
        "user_id", F.col("ts").alias("view_ts"), F.col("value").alias("view_value")
    )
    bought = t.events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return as_of_join(bought, views, ["user_id"], "ts", "view_ts", ["view_ts", "view_value"])


@query(
    "attach_label",
    f"""WITH {LABELLED} SELECT event_id, position, CASE WHEN event_type IN ('purchase', 'view', 'click')
              THEN CAST(value > 20 AS INT) WHEN event_type = 'signup' THEN CAST(value > 5 AS INT) END AS status FROM flat""",
)
def _(t):
    flat = flatten(payload(t), RECORD, FIELDS, MODEL)
    return attach_label(flat, label_sources(t), "event_id", "status").select("event_id", "position", "status")


@query("row_count", "SELECT count(*) AS rows, 11 AS columns FROM lineitem")
def _(t):
    return aggregates.row_count(t.lineitem)


@query("value_counts", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return aggregates.value_counts(t.orders, "o_orderstatus")


@query(
    "value_shares",
    f"""WITH {SALES} SELECT c_mktsegment, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM sales GROUP BY 1""",
)
def _(t):
    return aggregates.value_shares(sales(t), "c_mktsegment").withColumn("share", F.round("share", 6))


@query("distinct_values", "SELECT DISTINCT event_type FROM events")
def _(t):
    return aggregates.distinct_values(t.events, "event_type")


@query("class_count", "SELECT count(DISTINCT o_orderstatus) AS classes FROM orders")
def _(t):
    return t.orders.agg(F.countDistinct("o_orderstatus").alias("classes"))


@query("global_max", "SELECT max(o_orderdate) AS last_date, CAST(max(year(o_orderdate)) AS INT) AS last_year FROM orders")
def _(t):
    return t.orders.agg(F.max("o_orderdate").alias("last_date"), F.max(F.year("o_orderdate")).alias("last_year"))


@query(
    "score_summary",
    f"""WITH {SCORED}, per_month AS (SELECT month, avg(CAST(y = prediction AS INT)) AS accuracy FROM scored GROUP BY 1)
        SELECT 'accuracy' AS metric, round(avg(accuracy), 6) AS mean, round(stddev_pop(accuracy), 6) AS std
        FROM per_month""",
)
def _(t):
    right = (F.col("y") == F.col("prediction")).cast("int")
    per_month = scored(t).groupBy("month").agg(F.avg(right).alias("accuracy"))
    summary = aggregates.score_summary(per_month.withColumn("metric", F.lit("accuracy")), "accuracy", ["metric"])
    return summary.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "top_suppliers",
    """SELECT l_suppkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue FROM lineitem GROUP BY 1
       ORDER BY 2 DESC, 1 LIMIT 10""",
)
def _(t):
    revenue = F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 4)
    return aggregates.top_n(t.lineitem.groupBy("l_suppkey").agg(revenue.alias("revenue")), "revenue", "l_suppkey", 10)


@query(
    "union_by_name",
    """SELECT c_custkey AS key, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL BY NAME SELECT s_suppkey AS key, s_nationkey AS nation, s_acctbal AS balance FROM supplier""",
)
def _(t):
    customer = t.customer.toDF("key", "name", "nation", "balance", "segment").drop("name")
    supplier = t.supplier.toDF("key", "name", "nation", "balance").drop("name")
    return aggregates.union_by_name(customer, supplier)
