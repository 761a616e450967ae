"""Sinks, table management and keyed feature tables."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from larkspur.operators import feature_table, tables
from larkspur.operators.versioned import VersionedTable
from larkspur.plans.inputs import VERSIONS, new_orders, old_orders
from larkspur.plans.registry import query
from larkspur.workspace import new_path, scratch_database

LINE = "l_orderkey, l_linenumber, l_suppkey, l_quantity, l_returnflag"
AT = "2024-05-01 12:00:00"


def _lines(t):
    return t.lineitem.select(*LINE.split(", "))


@query("overwrite_and_append_partitioned", f"SELECT {LINE} FROM lineitem UNION ALL SELECT {LINE} FROM lineitem")
def _(t):
    name = f"{scratch_database(t.spark)}.lines"
    tables.save_table(_lines(t), name, "overwrite", partition_by=["l_returnflag"], audit=False)
    tables.save_table(_lines(t), name, "append", partition_by=["l_returnflag"], audit=False)
    return t.spark.table(name)


@query("overwrite_table", f"SELECT {LINE} FROM lineitem")
def _(t):
    """The second write replaces the first; a third with mode ignore changes nothing."""
    name = f"{scratch_database(t.spark)}.lines"
    tables.save_table(_lines(t).withColumn("l_quantity", F.lit(0.0)), name, "error", audit=False)
    tables.save_table(_lines(t), name, "overwrite", audit=False)
    tables.save_table(_lines(t).withColumn("l_quantity", F.lit(1.0)), name, "ignore", audit=False)
    return t.spark.table(name)


@query(
    "audit_and_metadata_columns",
    f"""SELECT s_suppkey, s_name, TIMESTAMP '{AT}' AS update_timestamp_utc, 'weekly' AS job, 3 AS run
        FROM supplier""",
)
def _(t):
    name = f"{scratch_database(t.spark)}.supplier"
    rows = t.supplier.select("s_suppkey", "s_name")
    tables.save_table(rows, name, metadata={"job": "weekly", "run": 3}, at=AT)
    return t.spark.table(name).withColumn("update_timestamp_utc", F.col("update_timestamp_utc").cast("timestamp_ntz"))


@query(
    "table_exists",
    "SELECT true AS present, false AS absent, count(*) AS rows FROM customer",
)
def _(t):
    base = scratch_database(t.spark)
    tables.save_table(t.customer, f"{base}.customer", audit=False)
    present, absent = (tables.table_exists(t.spark, f"{base}.{n}") for n in ("customer", "customers"))
    return t.spark.table(f"{base}.customer").agg(
        F.lit(present).alias("present"), F.lit(absent).alias("absent"), F.count("*").alias("rows")
    )


@query("create_or_update", "SELECT s_suppkey, count(*) * 2 AS n FROM supplier GROUP BY 1")
def _(t):
    name = f"{scratch_database(t.spark)}.supplier"
    for _ in range(2):
        tables.create_or_update(t.supplier, name, audit=False)
    return t.spark.table(name).groupBy("s_suppkey").agg(F.count("*").alias("n"))


@query("create_or_update_overwrite", "SELECT s_suppkey, s_acctbal + 1 AS s_acctbal FROM supplier")
def _(t):
    name = f"{scratch_database(t.spark)}.supplier"
    rows = t.supplier.select("s_suppkey", "s_acctbal")
    tables.create_or_update(rows, name, "overwrite", audit=False)
    tables.create_or_update(rows.withColumn("s_acctbal", F.col("s_acctbal") + 1), name, "overwrite", audit=False)
    return t.spark.table(name)


@query("drop_table", "SELECT count(*) AS rows_before, true AS dropped, false AS dropped_again, false AS left_over FROM orders")
def _(t):
    name = f"{scratch_database(t.spark)}.orders"
    tables.save_table(t.orders, name, audit=False)
    rows = t.spark.table(name).count()
    found = (rows, tables.drop_table(t.spark, name), tables.drop_table(t.spark, name), tables.table_exists(t.spark, name))
    return t.spark.createDataFrame([found], "rows_before long, dropped boolean, dropped_again boolean, left_over boolean")


@query("truncate_table", "SELECT count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after, 5 AS columns FROM customer")
def _(t):
    name = f"{scratch_database(t.spark)}.customer"
    tables.save_table(t.customer, name, audit=False)
    before = t.spark.table(name).count()
    tables.truncate_table(t.spark, name)
    return t.spark.table(name).agg(
        F.lit(before).cast("long").alias("rows_before"), F.count("*").alias("rows_after")
    ).withColumn("columns", F.lit(len(t.spark.table(name).columns)))


@query(
    "insert_by_name",
    """SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
       UNION ALL SELECT -1 - o_orderkey, o_orderstatus, o_totalprice FROM orders""",
)
def _(t):
    """Two sources into one table; the second has its columns in another order."""
    name = f"{scratch_database(t.spark)}.orders"
    tables.save_table(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), name, audit=False)
    moved = t.orders.select("o_totalprice", "o_orderstatus", (-1 - F.col("o_orderkey")).alias("o_orderkey"))
    tables.insert_by_name(moved, name)
    return t.spark.table(name)


@query(
    "newest_rows",
    """WITH latest AS (SELECT max(o_orderdate) AS last_load FROM orders)
       SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= (SELECT last_load FROM latest)""",
)
def _(t):
    return tables.newest_rows(t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate")


@query(
    "key_violations",
    """SELECT l_orderkey, l_linenumber, count(*) AS occurrences, false AS has_null FROM lineitem
       GROUP BY 1, 2 HAVING count(*) > 1""",
)
def _(t):
    return feature_table.key_violations(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "create_feature_table",
    """SELECT c_custkey, c_mktsegment, c_acctbal, CAST(c_nationkey AS BIGINT) AS c_nationkey FROM customer""",
)
def _(t):
    name = f"{scratch_database(t.spark)}.features"
    declared = StructType(
        [
            StructField("c_custkey", LongType(), False),
            StructField("c_mktsegment", StringType()),
            StructField("c_acctbal", DoubleType()),
            StructField("c_nationkey", LongType()),
        ]
    )
    feature_table.create_feature_table(t.customer, name, ["c_custkey"], declared)
    return feature_table.read_feature_table(t.spark, name)


MERGED = f"""WITH {VERSIONS}
  SELECT * FROM old_orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new_orders)
  UNION ALL SELECT * FROM new_orders"""


@query("upsert", MERGED)
def _(t):
    return feature_table.upsert(old_orders(t), new_orders(t), ["o_orderkey"])


@query(
    "upsert_some_columns",
    f"""WITH {VERSIONS}
        SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, o.o_orderstatus,
               CASE WHEN n.o_orderkey IS NULL THEN o.o_totalprice ELSE n.o_totalprice END AS o_totalprice,
               n.o_orderpriority
        FROM old_orders o FULL JOIN new_orders n ON o.o_orderkey = n.o_orderkey""",
)
def _(t):
    """The updates lack a column the table has, and bring one it has not."""
    old = old_orders(t).select("o_orderkey", "o_orderstatus", "o_totalprice")
    new = new_orders(t).select("o_orderkey", "o_totalprice", "o_orderpriority")
    return feature_table.upsert(old, new, ["o_orderkey"])


@query(
    "latest_per_key",
    """SELECT user_id, event_id, ts, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def _(t):
    return feature_table.latest_per_key(t.events.select("user_id", "event_id", "ts", "value"), ["user_id"], ["ts"])


@query("merge_into_stored_table", MERGED)
def _(t):
    """Stored upsert, run twice: the second run must change nothing."""
    name = f"{scratch_database(t.spark)}.orders"
    feature_table.create_feature_table(old_orders(t), name, ["o_orderkey"], buckets=4)
    for _ in range(2):
        feature_table.merge_into(t.spark, name, new_orders(t), ["o_orderkey"])
    return feature_table.read_feature_table(t.spark, name)


@query(
    "incremental_load",
    """SELECT o_orderkey, CASE WHEN o_orderdate >= (SELECT max(o_orderdate) FROM orders) THEN o_totalprice ELSE 0 END
              AS o_totalprice FROM orders WHERE o_orderdate < (SELECT max(o_orderdate) FROM orders) OR o_totalprice > 0""",
)
def _(t):
    """A table of all earlier orders without prices; the rows of the newest load are merged into it, twice."""
    name = f"{scratch_database(t.spark)}.orders"
    last = t.orders.agg(F.max("o_orderdate")).scalar()
    earlier = t.orders.where(F.col("o_orderdate") < last).select("o_orderkey", F.lit(0.0).alias("o_totalprice"))
    feature_table.create_feature_table(earlier, name, ["o_orderkey"], buckets=4)
    for _ in range(2):
        feature_table.load_newest(t.spark, t.orders, name, ["o_orderkey"], "o_orderdate", ["o_orderkey", "o_totalprice"])
    return feature_table.read_feature_table(t.spark, name)


@query(
    "change_feed",
    f"""WITH {VERSIONS}, both_sides AS (
          SELECT o, n FROM old_orders o FULL JOIN new_orders n ON o.o_orderkey = n.o_orderkey)
        SELECT 'insert' AS change, n.* FROM both_sides WHERE o.o_orderkey IS NULL
        UNION ALL SELECT 'delete', o.* FROM both_sides WHERE n.o_orderkey IS NULL
        UNION ALL SELECT 'update_preimage', o.* FROM both_sides WHERE o IS DISTINCT FROM n AND o.o_orderkey = n.o_orderkey
        UNION ALL SELECT 'update_postimage', n.* FROM both_sides
          WHERE o IS DISTINCT FROM n AND o.o_orderkey = n.o_orderkey""",
)
def _(t):
    return feature_table.change_feed(old_orders(t), new_orders(t), ["o_orderkey"])


# Four versions of some columns of orders: prices that go up and back again, new orders, a new status, deleted orders.
_OWN = "o_orderkey, o_orderstatus, o_totalprice"
_STORED = f"SELECT {_OWN} FROM orders WHERE o_orderkey % 4 <> 0"
_LAST = """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
    FROM orders WHERE o_orderkey % 7 <> 0"""
_SECOND = f"""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice + 1 ELSE o_totalprice END
    AS o_totalprice FROM orders"""


def _versions(t) -> VersionedTable:
    table = VersionedTable(t.spark, new_path(t.spark, "versions"))
    orders = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    table.create(orders.where(key % 4 != 0), ["o_orderkey"], buckets=8)
    raised = F.when(key % 6 == 0, price + 1).otherwise(price)
    table.merge(orders.where((key % 4 == 0) | (key % 6 == 0)).withColumn("o_totalprice", raised))
    table.merge(orders.where(key % 6 == 0))
    table.merge(orders.where(key % 10 == 0).select("o_orderkey", F.lit("X").alias("o_orderstatus")))
    table.delete(orders.where(key % 7 == 0))
    return table


@query(
    "read_version",
    f"""SELECT 1 AS version, * FROM ({_STORED}) UNION ALL SELECT 2, * FROM ({_SECOND})
        UNION ALL SELECT 5, * FROM ({_LAST})""",
)
def _(t):
    """Old and new versions of one stored table, side by side."""
    table = _versions(t)
    first, second, last = (table.read(v).select(F.lit(v).alias("version"), "*") for v in (1, 2, 5))
    return first.unionByName(second).unionByName(last)


@query(
    "merge_change_feed",
    f"""WITH old AS ({_STORED}), new AS ({_LAST}), both_sides AS (
          SELECT o, n FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey)
        SELECT 'insert' AS change, n.* FROM both_sides WHERE o.o_orderkey IS NULL
        UNION ALL SELECT 'delete', o.* FROM both_sides WHERE n.o_orderkey IS NULL
        UNION ALL SELECT 'update_preimage', o.* FROM both_sides WHERE o IS DISTINCT FROM n AND o.o_orderkey = n.o_orderkey
        UNION ALL SELECT 'update_postimage', n.* FROM both_sides
          WHERE o IS DISTINCT FROM n AND o.o_orderkey = n.o_orderkey""",
)
def _(t):
    """The feed from version 1 to 5, from the change files of three merges and a delete; what cancels out is not in it."""
    return _versions(t).changes_between(1, 5)


@query(
    "change_log",
    """WITH steps AS (
         SELECT 2 AS v, o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS before,
           CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS after
         FROM orders WHERE o_orderkey % 4 = 0 OR o_orderkey % 6 = 0
         UNION ALL SELECT 3, o_orderkey, o_totalprice + 1, o_totalprice FROM orders WHERE o_orderkey % 6 = 0)
       SELECT v AS _version, CASE WHEN before IS NULL THEN 'insert' ELSE 'update_postimage' END AS change, o_orderkey,
         after AS o_totalprice FROM steps
       UNION ALL SELECT v, 'update_preimage', o_orderkey, before FROM steps WHERE before IS NOT NULL""",
)
def _(t):
    """Every change of the second and third version."""
    log = _versions(t).change_log(1, 3)
    return log.select(F.col("_version").cast("int").alias("_version"), "change", "o_orderkey", "o_totalprice")
