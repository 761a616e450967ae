"""Scans."""

from larkspur.operators.payload import REQUEST_ID
from larkspur.plans.inputs import FLAT, payload
from larkspur.plans.registry import query
from larkspur.sources import catalog, files
from larkspur.workspace import materialize, new_path, scratch_database

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
ORDER_TYPE = StructType(
    [
        StructField("o_orderkey", LongType()),
        StructField("o_custkey", LongType()),
        StructField("o_orderstatus", StringType()),
        StructField("o_totalprice", DoubleType()),
        StructField("o_orderpriority", StringType()),
    ]
)


@query("csv_scan", f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def _(t):
    path = new_path(t.spark, "csv")
    t.orders.select(ORDER_COLUMNS).write.option("header", "true").csv(path)
    return files.read_csv(t.spark, path, ORDER_TYPE)


@query("csv_scan_inferred", f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def _(t):
    """Types found by a scan of the file, and a separator passed as an option."""
    path = new_path(t.spark, "csv")
    t.orders.select(ORDER_COLUMNS).write.options(header="true", sep=";").csv(path)
    inferred = files.read_csv(t.spark, path, sep=";")
    return inferred.withColumns({c: F.col(c).cast("long") for c in ("o_orderkey", "o_custkey")})


NULLED = """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN NULL ELSE o_custkey END AS o_custkey,
              CASE o_orderstatus WHEN 'F' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN o_orderpriority IN ('4-NOT SPECIFIED', '5-LOW') THEN NULL ELSE o_totalprice END AS o_totalprice,
              o_orderpriority FROM orders"""


def _with_tokens(t):
    """A CSV folder in which all four spellings of null occur."""
    priority, text = F.col("o_orderpriority"), {c: F.col(c).cast("string") for c in ORDER_COLUMNS}
    text["o_custkey"] = (
        F.when(priority == "1-URGENT", "NA").when(priority == "2-HIGH", "N/A").otherwise(text["o_custkey"])
    )
    text["o_totalprice"] = (
        F.when(priority == "5-LOW", "").when(priority == "4-NOT SPECIFIED", "null").otherwise(text["o_totalprice"])
    )
    text["o_orderstatus"] = F.when(F.col("o_orderstatus") == "F", "N/A").otherwise(F.col("o_orderstatus"))
    path = new_path(t.spark, "csv")
    t.orders.select([c.alias(n) for n, c in text.items()]).write.option("header", "true").csv(path)
    return path


@query("csv_null_tokens", NULLED)
def _(t):
    return files.read_csv_with_null_tokens(t.spark, _with_tokens(t), ORDER_TYPE)


@query("csv_null_tokens_inferred", NULLED)
def _(t):
    """The same without declared types: they are found once the tokens are gone."""
    return files.read_csv_with_null_tokens(t.spark, _with_tokens(t))


@query("table_scan", "SELECT * FROM customer")
def _(t):
    name = f"{scratch_database(t.spark)}.customer"
    t.customer.write.saveAsTable(name)
    return catalog.read_table(t.spark, name)


@query(
    "sql_query",
    """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, count(*) AS n FROM lineitem
       GROUP BY 1, 2""",
)
def _(t):
    t.lineitem.createOrReplaceTempView("larkspur_lineitem")
    return catalog.read_sql(
        t.spark,
        """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, count(*) AS n
           FROM larkspur_lineitem GROUP BY l_returnflag, l_linestatus""",
    )


@query(
    "sql_file",
    """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
       WHERE o_totalprice >= 250000 AND o_orderpriority <> '5-LOW' GROUP BY 1""",
)
def _(t):
    """Text from a file, with both marker spellings and a table name as parameter."""
    t.orders.createOrReplaceTempView("larkspur_orders")
    path = new_path(t.spark, "sql")
    text = """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM IDENTIFIER(:source)
              WHERE o_totalprice >= :low AND o_orderpriority <> ${skipped} GROUP BY o_orderstatus"""
    t.spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    params = {"source": "larkspur_orders", "low": 250000.0, "skipped": "5-LOW"}
    return catalog.read_sql_file(t.spark, path, params)


@query(
    "payload_scan",
    f"""WITH {FLAT} SELECT databricks_request_id, timestamp_ms, execution_time_ms, count(*) AS records
        FROM flat GROUP BY ALL""",
)
def _(t):
    stored = materialize(payload(t), "payload")
    records = F.json_array_length(F.get_json_object("request", "$.dataframe_records"))
    return stored.select(REQUEST_ID, "timestamp_ms", "execution_time_ms", records.cast("long").alias("records"))
