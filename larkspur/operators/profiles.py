"""Quality profiles from counts that add up.

A row of a log counts once for its (label, prediction) pair and once for the value of each profiled column, per time
window and model. These counts are exact, and those of two parts of a log add up to those of both. So a stored profile
takes in new rows by adding their counts, and all statistics, exact medians included, come out of the sum.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.functions.columns import present, ratio
from larkspur.operators.ordering import running_totals
from larkspur.workspace import materialize

GROUP = ["window_start", "window_end", "model_name"]
#: Which count a row holds: of a (label, prediction) pair, or of a value of the column of that name.
PAIR = ""
_LABEL = "="
#: Distinct values of one column in one window and model that a task sorts.
HOT_VALUES = 5_000_000


def observations(
    df: DataFrame, time: str, model: str, label: str, prediction: str, numeric: Mapping[str, str] | list[str], every: str
) -> DataFrame:
    """What each row counts for: ``what, a, b`` in its window (``_window``) and model.

    Rows without a time are in no window; a missing label or prediction fails the query.
    """
    nothing = F.lit(None).cast("double").alias("b")
    cells = [F.struct(F.lit(PAIR).alias("what"), present(df, label).cast("double").alias("a"), present(df, prediction).cast("double").alias("b"))]
    cells += [F.struct(F.lit(c).alias("what"), F.col(c).cast("double").alias("a"), nothing) for c in numeric]
    window = F.window(time, every)
    rows = df.select(window.alias("_window"), F.col(model).alias("model_name"), F.explode(F.array(*cells)).alias("c"))
    return rows.select("_window", "model_name", "c.*")


def observation_counts(
    df: DataFrame, time: str, model: str, label: str, prediction: str, numeric: Mapping[str, str] | list[str], every: str
) -> DataFrame:
    """``n`` rows per window, model and ``what``: label ``a`` with prediction ``b``, or value ``a`` of a column.

    One pass and one shuffle.
    """
    rows = observations(df, time, model, label, prediction, numeric, every)
    start, end = F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end")
    return rows.groupBy(start, end, "model_name", "what", "a", "b").agg(F.count("*").alias("n"))


def merged(*counts: DataFrame) -> DataFrame:
    """The counts of several parts of a log together."""
    together = counts[0]
    for more in counts[1:]:
        together = together.unionByName(more)
    return together.groupBy(*GROUP, "what", "a", "b").agg(F.sum("n").alias("n"))


def _ranked(known: DataFrame) -> DataFrame:
    """Values with ``through``, the rows of their group up to and with them, and the group's ``size`` and ``mean``.

    Groups of moderate size are sorted by themselves. Where one has too many values for that, all are sorted over ranges.
    """
    group = [*GROUP, "what"]
    largest = known.groupBy(*group).agg(F.count("*").alias("values")).agg(F.max("values")).first()[0] or 0
    if largest <= HOT_VALUES:
        whole = Window.partitionBy(*group)
        through = F.sum("n").over(whole.orderBy("a").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        mean = F.sum(F.col("a") * F.col("n")).over(whole) / F.sum("n").over(whole)
        return known.withColumns({"through": through, "size": F.sum("n").over(whole), "mean": mean})
    running = materialize(running_totals(known, [*group, "a"], {"_through": "n"}), "running")
    sizes = running.groupBy(*group).agg(
        F.min(F.col("_through") - F.col("n")).alias("_before"),
        F.sum("n").alias("size"),
        (F.sum(F.col("a") * F.col("n")) / F.sum("n")).alias("mean"),
    )
    return running.join(sizes, group).withColumn("through", F.col("_through") - F.col("_before"))


def profile_of(counts: DataFrame, numeric: Mapping[str, str] | list[str]) -> DataFrame:
    """One row per window and model: statistics of the columns and the quality of the predictions.

    ``numeric`` names the columns, with the type of their extremes and medians if it is a mapping. ``counts`` is read three
    times; give a stored table. Sums of squares are taken around the group's own mean.
    """
    kinds = dict(numeric) if isinstance(numeric, Mapping) else dict.fromkeys(numeric, "double")
    pairs = counts.where(F.col("what") == PAIR)
    labels = pairs.select(*GROUP, F.lit(_LABEL).alias("what"), "a", "n")
    values = counts.where(F.col("what") != PAIR).select(*GROUP, "what", "a", "n").unionByName(labels)
    known = values.where(F.col("a").isNotNull())
    ranked = _ranked(known)
    middle = 2 * F.col("through") >= F.col("size")
    spread = F.col("n") * (F.col("a") - F.col("mean")) * (F.col("a") - F.col("mean"))
    statistics = ranked.groupBy(*GROUP, "what").agg(
        F.max("size").alias("size"), F.max("mean").alias("mean"), F.sum(spread).alias("spread"),
        F.min("a").alias("least"), F.max("a").alias("most"), F.min(F.when(middle, F.col("a"))).alias("median"),
    )
    empty = counts.where((F.col("what") != PAIR) & F.col("a").isNull())
    empty = empty.select(*GROUP, "what", F.col("n").alias("nulls"))

    # Each pair tells its true class about a row and a hit, and its predicted class about a guess.
    hit = F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("long")
    own = F.struct(F.col("a").alias("class"), F.col("n").alias("support"), zero.alias("guessed"), hit.alias("hits"))
    other = F.struct(F.col("b").alias("class"), zero.alias("support"), F.col("n").alias("guessed"), zero.alias("hits"))
    classes = pairs.select(*GROUP, F.explode(F.array(own, other)).alias("c")).select(*GROUP, "c.*")
    classes = classes.groupBy(*GROUP, "class").agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
    weighted = F.col("support") * ratio(2.0 * F.col("hits"), F.col("support") + F.col("guessed"))
    # Everything that a window needs beyond its pairs, in one small table.
    parts = statistics.unionByName(empty, allowMissingColumns=True).unionByName(
        classes.select(*GROUP, weighted.alias("weighted")), allowMissingColumns=True
    )
    parts = materialize(parts, "parts").unionByName(pairs.drop("what"), allowMissingColumns=True)

    n, error = F.sum("n"), F.col("b") - F.col("a")

    def of(what: str, name: str):
        return F.max(F.when(F.col("what") == what, F.col(name)))

    columns = [n.alias("rows")]
    for c, kind in kinds.items():
        columns += [
            F.coalesce(of(c, "nulls"), F.lit(0).cast("long")).alias(f"{c}_nulls"),
            of(c, "mean").alias(f"{c}_mean"),
            F.when(of(c, "size") > 1, F.sqrt(of(c, "spread") / (of(c, "size") - 1))).alias(f"{c}_stddev"),
            of(c, "least").cast(kind).alias(f"{c}_min"),
            of(c, "most").cast(kind).alias(f"{c}_max"),
            of(c, "median").cast(kind).alias(f"{c}_median"),
        ]
    squares = F.sum(F.col("n") * error * error)
    columns += [
        (squares / n).alias("mse"),
        F.sqrt(squares / n).alias("rmse"),
        (F.sum(F.col("n") * F.abs(error)) / n).alias("mae"),
        F.when(of(_LABEL, "spread") > 0, 1 - squares / of(_LABEL, "spread")).alias("r2"),
        ratio(F.sum(F.when(F.col("a") == F.col("b"), F.col("n")).otherwise(0)), n).alias("accuracy_score"),
        ratio(F.sum("weighted"), n).alias("f1_score_weighted"),
    ]
    return parts.groupBy(*GROUP).agg(*columns)
