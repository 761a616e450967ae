"""Inputs of the registered queries, all derived from whole driver tables, and the same inputs as SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from larkspur.functions.columns import to_epoch_millis
from larkspur.operators.payload import RECORDS, REQUEST_ID
from larkspur.operators.prep import FeatureSpec
from larkspur.plans.registry import Tables

# --- Business table: orders with their customer -------------------------------------------------------------------


def sales(t: Tables) -> DataFrame:
    customer = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_acctbal", "c_mktsegment")
    return t.orders.join(customer, "o_custkey").select(
        "o_orderkey",
        "o_totalprice",
        "c_acctbal",
        F.year("o_orderdate").alias("order_year"),
        F.month("o_orderdate").alias("order_month"),
        F.dayofmonth("o_orderdate").alias("order_day"),
        "o_orderpriority",
        "c_mktsegment",
        "o_orderstatus",
        "o_orderdate",
    )


SALES = """sales AS (
  SELECT o_orderkey, o_totalprice, c_acctbal, CAST(year(o_orderdate) AS INT) AS order_year,
         CAST(month(o_orderdate) AS INT) AS order_month, CAST(day(o_orderdate) AS INT) AS order_day,
         o_orderpriority, c_mktsegment, o_orderstatus, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey)"""


def sales_text(t: Tables) -> DataFrame:
    """The business table as it comes from a text file: every column a string."""
    raw = sales(t)
    return raw.select(
        *[F.col(c).cast("string").alias(c) for c in raw.columns if c != "o_orderdate"],
    )


SPEC = FeatureSpec(
    keys=["o_orderkey"],
    numeric=[
        {"name": "o_totalprice", "alias": "price", "dtype": "float64"},
        {"name": "c_acctbal", "alias": "balance", "dtype": "float64"},
        {"name": "order_year", "alias": "order_year", "dtype": "int16"},
        {"name": "order_month", "alias": "order_month", "dtype": "int16"},
        {"name": "order_day", "alias": "order_day", "dtype": "int16"},
    ],
    categorical=[
        {"name": "o_orderpriority", "alias": "priority", "dtype": "category"},
        {"name": "c_mktsegment", "alias": "segment", "dtype": "category"},
    ],
    target={"name": "o_orderstatus", "alias": "status", "dtype": "int", "mapping": {"F": 1, "O": 0, "P": 0}},
)

PREPARED = f"""{SALES}, prepared AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_totalprice AS price, c_acctbal AS balance,
         CAST(order_year AS SMALLINT) AS order_year, CAST(order_month AS SMALLINT) AS order_month,
         CAST(order_day AS SMALLINT) AS order_day, o_orderpriority AS priority, c_mktsegment AS segment,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 WHEN 'P' THEN 0 END AS status
  FROM sales)"""


def gappy(t: Tables) -> DataFrame:
    """The business table with unknown balances, segments and labels."""
    return sales(t).withColumns(
        {
            "c_acctbal": F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")),
            "c_mktsegment": F.nullif("c_mktsegment", F.lit("HOUSEHOLD")),
            "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
        }
    )


GAPPY = f"""{SALES}, gappy AS (
  SELECT o_orderkey, o_totalprice, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal, order_year, order_month,
         order_day, o_orderpriority, nullif(c_mktsegment, 'HOUSEHOLD') AS c_mktsegment,
         nullif(o_orderstatus, 'P') AS o_orderstatus, o_orderdate
  FROM sales)"""

# --- Predictions --------------------------------------------------------------------------------------------------


def scored(t: Tables) -> DataFrame:
    """Labels, two scores and their predictions. The first score has many ties, the second almost none."""
    score = F.round(F.col("o_totalprice") / 500000, 3)
    return t.orders.select(
        "o_orderkey",
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        score.alias("score"),
        (F.col("o_totalprice") / 500000).alias("fine_score"),
        (score >= 0.5).cast("int").alias("prediction"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int").alias("rival"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "F")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "O")
        .otherwise("P")
        .alias("guess"),
        F.month("o_orderdate").alias("month"),
    )


SCORED = """scored AS (
  SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INT) AS y, round(o_totalprice / 500000, 3) AS score,
         o_totalprice / 500000 AS fine_score, CAST(round(o_totalprice / 500000, 3) >= 0.5 AS INT) AS prediction,
         CAST(o_orderpriority IN ('1-URGENT', '2-HIGH') AS INT) AS rival, o_orderstatus AS status,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'F' WHEN o_orderpriority = '3-MEDIUM' THEN 'O'
              ELSE 'P' END AS guess,
         CAST(month(o_orderdate) AS INT) AS month
  FROM orders)"""

# --- Inference log ------------------------------------------------------------------------------------------------

RECORD = StructType(
    [StructField("event_id", LongType()), StructField("user_id", LongType()), StructField("value", DoubleType())]
)
FIELDS = {"event_id": "event_id", "user_id": "log_user_id", "value": "value"}
MODEL = "event_model"


def payload(t: Tables) -> DataFrame:
    """Every five events are one logged request. A request that starts with an error event got no usable response."""
    record = F.struct("event_id", "user_id", "value")
    prediction = (F.col("value") > 10).cast("double")
    grouped = t.events.groupBy(F.expr("event_id div 5").alias("request")).agg(
        F.array_sort(F.collect_list(F.struct("event_id", record.alias("r"), prediction.alias("p")))).alias("all"),
        F.min("ts").alias("first_ts"),
        F.min_by("event_type", "event_id").alias("first_type"),
    )
    response = F.to_json(F.struct(F.transform("all", lambda x: x["p"]).alias("predictions")))
    return grouped.select(
        to_epoch_millis(F.col("first_ts")).alias("timestamp_ms"),
        F.concat(F.lit("req-"), F.col("request").cast("string")).alias(REQUEST_ID),
        F.lit(12).cast("long").alias("execution_time_ms"),
        F.to_json(F.struct(F.transform("all", lambda x: x["r"]).alias(RECORDS))).alias("request"),
        F.when(F.col("first_type") == "error", "upstream timeout").otherwise(response).alias("response"),
    )


FLAT = """requests AS (
  SELECT event_id // 5 AS request, epoch_us(min(ts)) // 1000 AS timestamp_ms, arg_min(event_type, event_id) AS first_type
  FROM events GROUP BY 1),
flat AS (
  SELECT date_trunc('second', make_timestamp(r.timestamp_ms * 1000)) AS timestamp, r.timestamp_ms,
         'req-' || r.request AS databricks_request_id, CAST(12 AS BIGINT) AS execution_time_ms,
         CAST(row_number() OVER (PARTITION BY r.request ORDER BY e.event_id) - 1 AS INT) AS position,
         e.event_id, e.user_id AS log_user_id, e.value,
         CASE WHEN r.first_type <> 'error' THEN CAST(e.value > 10 AS DOUBLE) END AS prediction,
         'event_model' AS model_name, e.event_type
  FROM events e JOIN requests r ON e.event_id // 5 = r.request)"""


def label_sources(t: Tables) -> list[DataFrame]:
    """Two overlapping label tables; the first holds some keys twice."""
    first = t.events.where(F.col("event_type").isin("purchase", "view", "click"))
    first = first.select("event_id", (F.col("value") > 20).cast("int").alias("status"))
    again = t.events.where(F.col("event_type") == "view")
    again = again.select("event_id", (F.col("value") > 20).cast("int").alias("status"))
    second = t.events.where(F.col("event_type").isin("click", "signup"))
    second = second.select("event_id", (F.col("value") > 5).cast("int").alias("status"))
    return [first.union(again), second]


LABELLED = f"""{FLAT}, labelled AS (
  SELECT * EXCLUDE (event_type), CAST(CASE WHEN event_type IN ('purchase', 'view', 'click') THEN value > 20
                   WHEN event_type = 'signup' THEN value > 5 END AS DOUBLE) AS status
  FROM flat WHERE event_type <> 'error' AND prediction IS NOT NULL)"""

# --- Versions of a keyed table ------------------------------------------------------------------------------------


def old_orders(t: Tables) -> DataFrame:
    """What a table held before: orders up to the end of 1999."""
    return t.orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))


def new_orders(t: Tables) -> DataFrame:
    """What it holds now: the first year is gone, two years were added, and pending orders cost one more."""
    kept = t.orders.where(F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
    dearer = F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return kept.withColumn("o_totalprice", dearer)


VERSIONS = """old_orders AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'),
new_orders AS (
  SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
  FROM orders WHERE o_orderdate >= TIMESTAMP '1996-01-01')"""
