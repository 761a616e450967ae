"""Imputing, scaling and encoding. Fits are made on the table with gaps, then applied to all of it."""

from pyspark.sql import functions as F

from larkspur.operators.encode import Preprocessor, label_encode
from larkspur.operators.ordering import approximate_quantiles, exact_quantiles
from larkspur.plans.inputs import GAPPY, gappy
from larkspur.plans.registry import query

NUMBERS = ["o_totalprice", "c_acctbal"]
TEXTS = ["o_orderpriority", "c_mktsegment"]
KEY = ["o_orderkey"]


def _applied(t, drop=("rest",), digits=6, **options):
    """Fit, apply, round. Listed names only unless ``drop`` is empty."""
    rows = gappy(t)
    fitted = Preprocessor(drop=drop, **options).fit(rows, exclude=KEY)
    result = fitted.transform(rows, keep=KEY)
    numbers = {n: F.round(F.col(f"`{n}`"), digits) for n, kind in result.dtypes if kind == "double"}
    return result.withColumns(numbers)


def _numeric_sql(fill: str, scale: str) -> str:
    """Twin of one numeric strategy: ``fill`` and ``scale`` are templates over column x."""
    filled = ", ".join(f"coalesce({c}, {fill.format(x=c)}) AS {c}" for c in NUMBERS)
    outputs = ", ".join(f"round({scale.format(x=c)}, 6) AS num__{c}" for c in NUMBERS)
    return f"WITH {GAPPY}, filled AS (SELECT o_orderkey, {filled} FROM gappy) SELECT o_orderkey, {outputs} FROM filled"


MEAN = "(SELECT avg({x}) FROM gappy)"
MEDIAN = "(SELECT quantile_cont({x}, 0.5) FROM gappy)"
MODE = "(SELECT {x} FROM gappy WHERE {x} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, {x} LIMIT 1)"
STANDARD = "({x} - avg({x}) OVER ()) / stddev_pop({x}) OVER ()"
MINMAX = "({x} - min({x}) OVER ()) / (max({x}) OVER () - min({x}) OVER ())"
ROBUST = (
    "({x} - (SELECT quantile_cont({x}, 0.5) FROM filled)) / "
    "(SELECT quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) FROM filled)"
)

for _name, _missing, _fill, _strategy, _scale in (
    ("impute_mean_standard_scale", "mean", MEAN, "standard", STANDARD),
    ("impute_median_minmax_scale", "median", MEDIAN, "minmax", MINMAX),
    ("impute_most_frequent_robust_scale", "most_frequent", MODE, "robust", ROBUST),
    ("impute_median_robust_scale", "median", MEDIAN, "robust", ROBUST),
    ("impute_constant_minmax_scale", "constant", "-1.5", "minmax", MINMAX),
    ("no_impute_standard_scale", "none", "NULL", "standard", STANDARD),
):

    @query(_name, _numeric_sql(_fill, _scale))
    def _(t, missing=_missing, strategy=_strategy):
        fill = -1.5 if missing == "constant" else None
        return _applied(
            t, numeric=NUMBERS, numeric_strategy=strategy, missing_strategy=missing, fill_value=fill
        )


# The commonest segment fills its gaps, then one flag per category.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"]
FILLED = f"""{GAPPY}, filled AS (
  SELECT *, coalesce(c_mktsegment, {MODE.format(x='c_mktsegment')}) AS segment FROM gappy)"""


def _flags(column: str, source: str, values) -> str:
    return ", ".join(f"CAST({source} = '{v}' AS DOUBLE) AS \"cat__{column}_{v}\"" for v in values)


@query(
    "onehot_encode",
    f"""WITH {FILLED} SELECT o_orderkey, {_flags('o_orderpriority', 'o_orderpriority', PRIORITIES)},
              {_flags('c_mktsegment', 'segment', SEGMENTS)} FROM filled""",
)
def _(t):
    return _applied(t, categorical=TEXTS)


@query(
    "onehot_encode_unseen",
    f"""WITH {GAPPY} SELECT o_orderkey, {_flags('o_orderpriority', 'o_orderpriority', PRIORITIES[:3])} FROM gappy""",
)
def _(t):
    """Fitted without two of the priorities: their rows get zeros everywhere."""
    rows = gappy(t)
    known = rows.where(F.col("o_orderpriority").isin(PRIORITIES[:3]))
    fitted = Preprocessor(categorical=["o_orderpriority"], drop=["rest"]).fit(known)
    return fitted.transform(rows, keep=KEY)


@query(
    "ordinal_encode",
    f"""WITH {FILLED}, priorities AS (
          SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS p FROM gappy GROUP BY 1),
        segments AS (SELECT segment, row_number() OVER (ORDER BY segment) - 1 AS s FROM filled GROUP BY 1)
        SELECT o_orderkey, CAST(p AS DOUBLE) AS cat__o_orderpriority, CAST(s AS DOUBLE) AS cat__c_mktsegment
        FROM filled JOIN priorities USING (o_orderpriority) JOIN segments USING (segment)""",
)
def _(t):
    return _applied(t, categorical=TEXTS, categorical_strategy="ordinal")


@query(
    "ordinal_encode_unseen",
    f"""WITH {GAPPY} SELECT o_orderkey, CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1
              WHEN '3-MEDIUM' THEN 2 ELSE -1 END AS DOUBLE) AS cat__o_orderpriority FROM gappy""",
)
def _(t):
    rows = gappy(t)
    known = rows.where(F.col("o_orderpriority").isin(PRIORITIES[:3]))
    fitted = Preprocessor(categorical=["o_orderpriority"], categorical_strategy="ordinal", drop=["rest"]).fit(known)
    return fitted.transform(rows, keep=KEY)


@query(
    "binary_encode",
    f"""WITH {GAPPY}, filled AS (
          SELECT *, coalesce(o_orderstatus, {MODE.format(x='o_orderstatus')}) AS status FROM gappy)
        SELECT o_orderkey, CAST(status = 'O' AS DOUBLE) AS "cat__o_orderstatus_O",
               {_flags('o_orderpriority', 'o_orderpriority', PRIORITIES)} FROM filled""",
)
def _(t):
    """Two known states give one flag, five priorities give five."""
    return _applied(t, categorical=["o_orderstatus", "o_orderpriority"], categorical_strategy="binary")


@query(
    "assemble_columns",
    f"""WITH {GAPPY} SELECT o_orderkey, round((o_totalprice - min(o_totalprice) OVER ()) /
              (max(o_totalprice) OVER () - min(o_totalprice) OVER ()), 6) AS num__o_totalprice,
              order_year AS pass__order_year, order_month AS remainder__order_month, order_day AS remainder__order_day,
              round(c_acctbal, 6) AS remainder__c_acctbal, o_orderpriority AS remainder__o_orderpriority,
              c_mktsegment AS remainder__c_mktsegment, o_orderstatus AS remainder__o_orderstatus,
              o_orderdate AS remainder__o_orderdate FROM gappy""",
)
def _(t):
    """Listed columns first, the rest passes through."""
    return _applied(t, drop=(), numeric=["o_totalprice"], numeric_strategy="minmax", passthrough=["order_year"])


@query(
    "label_encode",
    """WITH priorities AS (
         SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS p FROM orders GROUP BY 1),
       statuses AS (SELECT o_orderstatus, row_number() OVER (ORDER BY o_orderstatus) - 1 AS s FROM orders GROUP BY 1),
       dates AS (SELECT o_orderdate, row_number() OVER (ORDER BY o_orderdate) - 1 AS d FROM orders GROUP BY 1)
       SELECT o_orderkey, o_custkey, s AS o_orderstatus, o_totalprice, d AS o_orderdate, p AS o_orderpriority
       FROM orders JOIN priorities USING (o_orderpriority) JOIN statuses USING (o_orderstatus)
            JOIN dates USING (o_orderdate)""",
)
def _(t):
    return label_encode(t.orders)


@query(
    "exact_quantiles",
    """SELECT c AS "column", round(q[1], 6) AS q25, round(q[2], 6) AS q50, round(q[3], 6) AS q75 FROM (
         SELECT 'l_extendedprice' AS c, quantile_cont(l_extendedprice, [0.25, 0.5, 0.75]) AS q FROM lineitem
         UNION ALL SELECT 'l_quantity', quantile_cont(l_quantity, [0.25, 0.5, 0.75]) FROM lineitem)""",
)
def _(t):
    found = exact_quantiles(t.lineitem, ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.75])
    table = t.spark.createDataFrame([(c, *q) for c, q in found.items()], "column string, q25 double, q50 double, q75 double")
    return table.withColumns({c: F.round(c, 6) for c in ("q25", "q50", "q75")})


@query(
    "approximate_quantiles",
    """SELECT c AS "column", s AS share, count(*) AS rows, true AS close FROM lineitem,
              (VALUES ('l_extendedprice'), ('l_quantity')) a(c), (VALUES (0.25::DOUBLE), (0.5), (0.75)) b(s) GROUP BY 1, 2""",
)
def _(t):
    """Each sketched quantile lies within a thousandth of the rank it was asked for."""
    columns, shares = ["l_extendedprice", "l_quantity"], [0.25, 0.5, 0.75]
    found = approximate_quantiles(t.lineitem, columns, shares)
    checks = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(s).alias("share"),
            F.count("*").alias("rows"),
            (
                (F.count_if(F.col(c) < q) / F.count("*") <= s + 0.001)
                & (F.count_if(F.col(c) <= q) / F.count("*") >= s - 0.001)
            ).alias("close"),
        )
        for c in columns
        for s, q in zip(shares, found[c], strict=True)
    ]
    return t.lineitem.agg(F.array(*checks).alias("checks")).select(F.inline("checks"))
