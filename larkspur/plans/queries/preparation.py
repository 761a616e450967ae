"""Validation, projections and scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larkspur.functions.columns import from_epoch_millis, to_epoch_millis
from larkspur.operators import payload, prep
from larkspur.operators.aggregates import value_shares
from larkspur.plans.inputs import FIELDS, FLAT, GAPPY, MODEL, PREPARED, RECORD, SALES, SPEC
from larkspur.plans.inputs import gappy, sales, sales_text
from larkspur.plans.inputs import payload as logged
from larkspur.plans.registry import query


@query(
    "missing_columns",
    """SELECT missing, count(*) AS rows FROM orders, (VALUES ('no_such_price'), ('no_such_segment')) v(missing)
       GROUP BY 1""",
)
def _(t):
    """The columns a table of so many rows lacks."""
    orders = t.orders
    missing = prep.missing_columns(orders, [*orders.columns, "no_such_price", "no_such_segment"])
    names = F.explode(F.array(*[F.lit(c) for c in missing])).alias("missing")
    return orders.agg(F.count("*").alias("rows")).select(names, "rows")


@query(
    "rename_columns",
    """SELECT o_orderkey AS order_id, o_custkey, o_orderstatus AS status, o_totalprice AS price, o_orderdate,
              o_orderpriority FROM orders""",
)
def _(t):
    return prep.rename_columns(
        t.orders, {"o_orderkey": "order_id", "o_orderstatus": "status", "o_totalprice": "price"}
    )


@query(
    "cast_columns",
    f"""WITH {SALES} SELECT o_orderkey, CAST(order_year AS SMALLINT) AS order_year,
               CAST(order_month AS SMALLINT) AS order_month, CAST(trunc(o_totalprice) AS INT) AS o_totalprice,
               o_orderpriority FROM sales""",
)
def _(t):
    types = {"order_year": "smallint", "order_month": "smallint", "o_totalprice": "int", "o_orderpriority": "string"}
    return sales(t).select("o_orderkey", *types).transform(prep.cast_columns, types)


@query(
    "cast_columns_lenient",
    """SELECT o_orderkey, o_orderstatus, try_cast(o_orderpriority AS INT) AS o_orderpriority,
              CASE WHEN trunc(o_totalprice) BETWEEN -32768 AND 32767 THEN CAST(trunc(o_totalprice) AS SMALLINT) END
              AS o_totalprice FROM orders""",
)
def _(t):
    types = {"o_orderpriority": "int", "o_totalprice": "smallint"}
    return t.orders.select("o_orderkey", "o_orderstatus", *types).transform(prep.cast_columns, types, strict=False)


@query(
    "cast_rejects",
    """SELECT 'o_orderpriority' AS "column", CAST(count_if(try_cast(o_orderpriority AS INT) IS NULL) AS BIGINT) AS rejected FROM orders
       UNION ALL SELECT 'o_totalprice', CAST(count_if(trunc(o_totalprice) NOT BETWEEN -32768 AND 32767) AS BIGINT) FROM orders""",
)
def _(t):
    return prep.cast_rejects(t.orders, {"o_orderpriority": "int", "o_totalprice": "smallint"})


@query(
    "map_target",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus FROM orders",
)
def _(t):
    return prep.map_target(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": 1, "O": 0})


@query(
    "null_report",
    f"""WITH {GAPPY}, counted AS (
          SELECT 'o_totalprice' AS "column", count_if(o_totalprice IS NULL) AS nulls, count(*) AS rows FROM gappy
          UNION ALL SELECT 'c_acctbal', count_if(c_acctbal IS NULL), count(*) FROM gappy
          UNION ALL SELECT 'c_mktsegment', count_if(c_mktsegment IS NULL), count(*) FROM gappy
          UNION ALL SELECT 'o_orderstatus', count_if(o_orderstatus IS NULL), count(*) FROM gappy)
        SELECT "column", CAST(nulls AS BIGINT) AS nulls, rows, round(100.0 * nulls / rows, 6) AS percent FROM counted""",
)
def _(t):
    report = prep.null_report(gappy(t), ["o_totalprice", "c_acctbal", "c_mktsegment", "o_orderstatus"])
    return report.withColumn("percent", F.round("percent", 6))


@query(
    "custom_transformation",
    """SELECT o_orderkey, o_totalprice, o_totalprice * 2 AS doubled, CAST(year(o_orderdate) AS INT) AS order_year
       FROM orders""",
)
def _(t):
    class Custom:
        def apply_transformations(self, df):
            return df.withColumns({"doubled": F.col("o_totalprice") * 2, "order_year": F.year("o_orderdate")})

    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    return prep.apply_custom(rows, Custom()).drop("o_orderdate")


@query(
    "prepare",
    f"WITH {PREPARED} SELECT *, CAST(price / 1000 AS DOUBLE) AS price_in_thousands FROM prepared",
)
def _(t):
    return prep.prepare(
        sales_text(t), SPEC, custom=lambda df: df.withColumn("price_in_thousands", F.col("price") / 1000)
    )


@query(
    "prepare_class_shares",
    f"""WITH {PREPARED} SELECT status, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share
        FROM prepared GROUP BY status""",
)
def _(t):
    prepared = prep.prepare(sales_text(t), SPEC)
    return value_shares(prepared, "status").withColumn("share", F.round("share", 6))


@query("select_key_and_label", "SELECT o_orderkey, o_orderstatus FROM orders")
def _(t):
    return t.orders.select("o_orderkey", "o_orderstatus")


@query("exclude_columns", "SELECT * EXCLUDE (o_custkey, o_orderdate) FROM orders")
def _(t):
    return prep.drop_columns(t.orders, ["o_custkey", "o_orderdate"])


@query(
    "drop_incomplete_rows",
    f"""WITH {GAPPY} SELECT o_orderkey, c_acctbal, c_mktsegment FROM gappy
        WHERE c_acctbal IS NOT NULL AND o_orderstatus IS NOT NULL""",
)
def _(t):
    return prep.drop_incomplete(gappy(t), ["c_acctbal", "o_orderstatus"]).select(
        "o_orderkey", "c_acctbal", "c_mktsegment"
    )


@query(
    "parse_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              CAST(NULL AS BIGINT) AS from_bad_text FROM events""",
)
def _(t):
    kind = StructType([StructField("k", LongType())])
    bad = F.from_json(F.concat(F.lit("{"), F.col("props")), kind)
    return t.events.select("event_id", F.from_json("props", kind)["k"].alias("k"), bad["k"].alias("from_bad_text"))


@query("explode_records", f"WITH {FLAT} SELECT databricks_request_id, position, event_id, value FROM flat")
def _(t):
    return (
        logged(t)
        .transform(payload.parse, RECORD)
        .transform(payload.explode_records)
        .select(payload.REQUEST_ID, "position", "record.event_id", "record.value")
    )


@query(
    "nested_projection",
    f"WITH {FLAT} SELECT event_id, log_user_id, value, prediction FROM flat",
)
def _(t):
    return payload.flatten(logged(t), RECORD, FIELDS, MODEL).select(*FIELDS.values(), "prediction")


@query(
    "array_element",
    f"""WITH {FLAT} SELECT databricks_request_id, max(CASE WHEN position = 0 THEN prediction END) AS first_prediction,
                CAST(NULL AS DOUBLE) AS beyond FROM flat GROUP BY 1""",
)
def _(t):
    return (
        logged(t)
        .transform(payload.parse, RECORD)
        .select(
            payload.REQUEST_ID,
            payload.prediction_at(F.lit(0)).alias("first_prediction"),
            payload.prediction_at(F.lit(99)).alias("beyond"),
        )
    )


@query(
    "epoch_millis",
    "SELECT event_id, epoch_us(ts) // 1000 AS timestamp_ms, date_trunc('second', ts) AS timestamp FROM events",
)
def _(t):
    millis = to_epoch_millis(F.col("ts"))
    return t.events.select(
        "event_id",
        millis.alias("timestamp_ms"),
        from_epoch_millis(millis).cast("timestamp_ntz").alias("timestamp"),
    )


@query(
    "coalesce_literal_cast",
    f"""WITH {GAPPY} SELECT o_orderkey, coalesce(c_mktsegment, 'unknown') AS segment, coalesce(c_acctbal, 0.0) AS balance,
              CAST(order_year AS DOUBLE) AS order_year, CAST(o_orderkey AS VARCHAR) AS order_text, 'v1' AS model_name
        FROM gappy""",
)
def _(t):
    return gappy(t).select(
        "o_orderkey",
        F.coalesce("c_mktsegment", F.lit("unknown")).alias("segment"),
        F.coalesce("c_acctbal", F.lit(0.0)).alias("balance"),
        F.col("order_year").cast("double").alias("order_year"),
        F.col("o_orderkey").cast("string").alias("order_text"),
        F.lit("v1").alias("model_name"),
    )


@query("to_utc", "SELECT event_id, ts AS same, ts - INTERVAL 2 HOUR AS from_plus_two FROM events")
def _(t):
    # A fixed offset in place of a named zone, so that no summer time comes in.
    at = F.col("ts").cast("timestamp")
    return t.events.select(
        "event_id",
        F.to_utc_timestamp(at, "UTC").cast("timestamp_ntz").alias("same"),
        F.to_utc_timestamp(at, "+02:00").cast("timestamp_ntz").alias("from_plus_two"),
    )


@query(
    "arithmetic_and_comparison",
    """SELECT o_orderkey, 1.0::DOUBLE * o_orderkey AS as_double, o_totalprice * 2 AS doubled,
              abs(250000 - o_totalprice) AS distance, round(sqrt(o_totalprice), 6) AS root,
              CAST(o_totalprice / 500000 > 0.5 AS INT) AS above, CAST(o_totalprice / 500000 >= 0.25 AS INT) AS reached,
              'INS' || o_orderkey AS synthetic_key FROM orders""",
)
def _(t):
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        (1.0 * F.col("o_orderkey")).alias("as_double"),
        (price * 2).alias("doubled"),
        F.abs(250000 - price).alias("distance"),
        F.round(F.sqrt(price), 6).alias("root"),
        (price / 500000 > 0.5).cast("int").alias("above"),
        (price / 500000 >= 0.25).cast("int").alias("reached"),
        F.concat(F.lit("INS"), F.col("o_orderkey").cast("string")).alias("synthetic_key"),
    )


@query(
    "request_records",
    f"""WITH {FLAT}, bodies AS (
          SELECT databricks_request_id, count(*) AS records, CAST(sum(event_id) AS BIGINT) AS event_sum, round(sum(value), 4) AS value_sum
          FROM flat GROUP BY 1)
        SELECT * FROM bodies""",
)
def _(t):
    rows = t.events.withColumn(payload.REQUEST_ID, F.expr("concat('req-', event_id div 5)"))
    bodies = payload.to_requests(rows, ["event_id", "user_id", "value"], [payload.REQUEST_ID], ["event_id"])
    parsed = F.from_json("request", payload.request_type(RECORD))[payload.RECORDS]
    total = F.aggregate("r", F.lit(0.0), lambda a, x: a + x["value"])
    return bodies.select(payload.REQUEST_ID, parsed.alias("r")).select(
        payload.REQUEST_ID,
        F.size("r").cast("long").alias("records"),
        F.aggregate("r", F.lit(0).cast("long"), lambda a, x: a + x["event_id"]).alias("event_sum"),
        F.round(total, 4).alias("value_sum"),
    )


@query(
    "request_per_row",
    "SELECT event_id, '{\"dataframe_records\":[{\"event_id\":' || event_id || ',\"user_id\":' || user_id || '}]}' AS request"
    " FROM events",
)
def _(t):
    bodies = payload.to_requests(t.events, ["event_id", "user_id"])
    first = F.from_json("request", payload.request_type(RECORD))[payload.RECORDS][0]
    return bodies.select(first["event_id"].alias("event_id"), "request")


@query("first_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def _(t):
    return prep.first_rows(t.orders, ["o_orderkey"], 5)
