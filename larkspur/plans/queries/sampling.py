"""Splits, balancing and synthetic rows."""

from pyspark.sql import functions as F

from larkspur.operators import resample, splits, synthetic
from larkspur.plans.inputs import SALES, sales
from larkspur.plans.registry import query

HASH = "md5(concat_ws(':', o_orderkey, 42))"


@query(
    "random_split",
    f"""WITH ranked AS (SELECT *, row_number() OVER (ORDER BY {HASH}) AS r, count(*) OVER () AS n FROM orders)
        SELECT o_orderkey, o_orderstatus, CASE WHEN r <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM ranked""",
)
def _(t):
    train, test = splits.random_split(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 0.2, 42)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query(
    "stratified_split",
    f"""WITH ranked AS (
          SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY {HASH}) AS r FROM orders),
        classes AS (
          SELECT o_orderpriority, count(*) AS k, ceil(sum(count(*)) OVER () * 0.25) AS wanted, sum(count(*)) OVER () AS n
          FROM orders GROUP BY 1),
        shares AS (
          SELECT *, CAST(wanted * k AS BIGINT) // CAST(n AS BIGINT) AS base,
                 row_number() OVER (ORDER BY CAST(wanted * k AS BIGINT) % CAST(n AS BIGINT) DESC, k DESC, o_orderpriority)
                 AS place FROM classes),
        quotas AS (
          SELECT o_orderpriority, base + CASE WHEN place <= max(wanted) OVER () - sum(base) OVER () THEN 1 ELSE 0 END AS q
          FROM shares)
        SELECT o_orderkey, o_orderpriority, CASE WHEN r <= q THEN 'test' ELSE 'train' END AS split
        FROM ranked JOIN quotas USING (o_orderpriority)""",
)
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    train, test = splits.stratified_split(rows, "o_orderpriority", ["o_orderkey"], 0.25, 42)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query(
    "split_class_shares",
    f"""WITH ranked AS (SELECT *, row_number() OVER (ORDER BY {HASH}) AS r, count(*) OVER () AS n FROM orders),
        parts AS (SELECT o_orderstatus, CASE WHEN r <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split FROM ranked)
        SELECT split, o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 6) AS share
        FROM parts GROUP BY 1, 2""",
)
def _(t):
    train, test = splits.random_split(t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], 0.2, 42)
    both = train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))
    counted = both.groupBy("split", "o_orderstatus").agg(F.count("*").alias("n"))
    from larkspur.operators.aggregates import with_share_of

    return with_share_of(counted, "n", ["split"], "share").withColumn("share", F.round("share", 6))


@query(
    "cross_validation_folds",
    f"""WITH ranked AS (
          SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {HASH}) - 1 AS r,
                 count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)
        SELECT o_orderkey, o_orderstatus, CAST((r >= n // 5) AS INT) + CAST((r >= 2 * n // 5) AS INT)
               + CAST((r >= 3 * n // 5) AS INT) + CAST((r >= 4 * n // 5) AS INT) AS fold FROM ranked""",
)
def _(t):
    return splits.with_fold(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", ["o_orderkey"], 5, 42)


@query(
    "over_sample",
    f"""WITH {SALES}, ranked AS (
          SELECT o_orderkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {HASH}) - 1 AS r FROM sales),
        sizes AS (SELECT c_mktsegment, count(*) AS n, max(count(*)) OVER () AS top FROM sales GROUP BY 1),
        drawn AS (
          SELECT c_mktsegment, CAST('0x' || substr(md5(concat_ws(':', c_mktsegment, d, 42)), 1, 15) AS BIGINT) % n AS r
          FROM sizes, LATERAL (SELECT unnest(range(top - n)) AS d)),
        copied AS (SELECT c_mktsegment, r, row_number() OVER (PARTITION BY c_mktsegment, r) AS copy FROM drawn)
        SELECT o_orderkey, c_mktsegment, 0 AS copy FROM ranked
        UNION ALL SELECT o_orderkey, c_mktsegment, CAST(copy AS INT) FROM ranked JOIN copied USING (c_mktsegment, r)""",
)
def _(t):
    return resample.over_sample(sales(t).select("o_orderkey", "c_mktsegment"), "c_mktsegment", ["o_orderkey"], 42)


@query(
    "under_sample",
    f"""WITH {SALES}, ranked AS (
          SELECT o_orderkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {HASH}) AS r,
                 count(*) OVER (PARTITION BY c_mktsegment) AS n FROM sales)
        SELECT o_orderkey, c_mktsegment FROM ranked WHERE r <= (SELECT min(n) FROM ranked)""",
)
def _(t):
    return resample.under_sample(sales(t).select("o_orderkey", "c_mktsegment"), "c_mktsegment", ["o_orderkey"], 42)


SYNTHETIC_COLUMNS = ["o_totalprice", "order_year", "o_orderpriority", "c_mktsegment"]
# The value at a random place of each sorted column.
SYNTHETIC = f"""{SALES}, placed AS (
  SELECT 'o_totalprice' AS c, CAST(o_totalprice AS VARCHAR) AS v, row_number() OVER (ORDER BY o_totalprice) - 1 AS r FROM sales
  UNION ALL SELECT 'order_year', CAST(order_year AS VARCHAR), row_number() OVER (ORDER BY order_year) - 1 FROM sales
  UNION ALL SELECT 'o_orderpriority', o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 FROM sales
  UNION ALL SELECT 'c_mktsegment', c_mktsegment, row_number() OVER (ORDER BY c_mktsegment) - 1 FROM sales),
drawn AS (
  SELECT i, c, CAST('0x' || substr(md5(concat_ws(':', i, c, 42)), 1, 15) AS BIGINT) % (SELECT count(*) FROM sales) AS r
  FROM range(200) a(i) CROSS JOIN
       (VALUES ('o_totalprice'), ('order_year'), ('o_orderpriority'), ('c_mktsegment')) b(c)),
synthetic AS (
  SELECT 'INS' || (40000 + i) AS row_key,
         CAST(max(v) FILTER (c = 'o_totalprice') AS DOUBLE) AS o_totalprice,
         CAST(max(v) FILTER (c = 'order_year') AS INT) AS order_year,
         max(v) FILTER (c = 'o_orderpriority') AS o_orderpriority, max(v) FILTER (c = 'c_mktsegment') AS c_mktsegment
  FROM drawn JOIN placed USING (c, r) GROUP BY i)"""


@query("synthetic_rows", f"WITH {SYNTHETIC} SELECT * FROM synthetic")
def _(t):
    return synthetic.synthetic_rows(sales(t), "row_key", SYNTHETIC_COLUMNS, 200, 42)


@query(
    "synthetic_rows_with_drift",
    f"""WITH {SYNTHETIC} SELECT row_key, o_totalprice * 2 AS o_totalprice, o_orderpriority, c_mktsegment,
          CAST((SELECT max(order_year) FROM sales) + 1
               + CAST('0x' || substr(md5(concat_ws(':', row_key, 'order_year', 42)), 1, 15) AS BIGINT) % 2 AS INT)
          AS order_year FROM synthetic""",
)
def _(t):
    source = sales(t)
    rows = synthetic.synthetic_rows(source, "row_key", SYNTHETIC_COLUMNS, 200, 42)
    return synthetic.add_drift(rows, source, "row_key", ["o_totalprice"], "order_year", 2, 42)
