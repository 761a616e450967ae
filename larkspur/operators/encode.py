"""Imputing, scaling and encoding: fit on one table, apply to any.

A fit is a few aggregations whose result is a handful of numbers. What it leaves behind is one SQL expression per output
column, so applying it is a plain projection, and the same expressions make a stage of a saved Spark model.

A column with more categories than a list of expressions should hold keeps them in a table, the dictionary, numbered across the
cluster. Applying it is a join, which adaptive execution splits at hot values; one-hot columns become one sparse vector. No
category reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Collection, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType, TimestampNTZType, TimestampType

from larkspur.operators.ordering import approximate_quantiles, exact_quantiles, with_position
from larkspur.workspace import materialize, new_path

# Strategies.
NUMERIC = ("standard", "minmax", "robust", "none")
CATEGORICAL = ("onehot", "ordinal", "binary", "none")
MISSING = ("mean", "median", "most_frequent", "constant", "none")


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _double(column: str) -> str:
    """SQL of a numeric column; NaN counts as missing."""
    return f"nullif(CAST({_name(column)} AS DOUBLE), double('NaN'))"


def _number(value: float) -> str:
    if not math.isfinite(value):
        return f"CAST('{value}' AS DOUBLE)"
    return f"{float(value)!r}D"


@dataclass(frozen=True)
class Dictionary:
    """The categories of one column in a table. ``text`` is SQL of the looked-up value, ``code`` SQL of the output."""

    column: str
    path: str
    text: str
    code: str
    #: Number of codes, for a column that becomes a one-hot vector.
    size: int | None = None

    @property
    def output(self) -> str:
        return f"cat__{self.column}"


@dataclass(frozen=True)
class FittedPreprocessor:
    """Output columns in order, each with the SQL expression that makes it; dictionaries make theirs by a join."""

    outputs: tuple[tuple[str, str], ...]
    dictionaries: tuple[Dictionary, ...] = ()

    @property
    def names(self) -> list[str]:
        return [name for name, _ in self.outputs]

    def vectors(self) -> dict[str, int]:
        """Outputs that are one-hot vectors, and their sizes."""
        return {d.output: d.size for d in self.dictionaries if d.size is not None}

    def _expressions(self) -> list[str]:
        return [f"{sql} AS {_name(name)}" for name, sql in self.outputs]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        if not self.dictionaries:
            return df.selectExpr(*[_name(c) for c in keep], *self._expressions())
        return PipelineModel(self.stages(df.sparkSession)).transform(df).select(*keep, *self.names)

    def stages(self, spark: SparkSession) -> list[Transformer]:
        """The same columns, added to the input columns, as stages of a Spark ML model."""
        vectors = self.vectors()
        columns = [f"{sql} AS {_name(name if name not in vectors else '_code_' + name)}" for name, sql in self.outputs]
        joins = [
            f"LEFT JOIN (SELECT value AS _value_{i}, code AS _code_{i} FROM parquet.`{d.path}` WHERE column = {_text(d.column)}) "
            f"ON _value_{i} = {d.text}"
            for i, d in enumerate(self.dictionaries)
        ]
        own = "*" if not joins else "__THIS__.*"
        found: list[Transformer] = [SQLTransformer(statement=f"SELECT {own}, {', '.join(columns)} FROM __THIS__ {' '.join(joins)}")]
        if vectors:
            # The code after the last one is an unknown category: all zeros.
            encoder = OneHotEncoder(
                inputCols=[f"_code_{v}" for v in vectors], outputCols=list(vectors), dropLast=True, handleInvalid="keep"
            )
            largest = [tuple(float(n - 1) for n in vectors.values())]
            found.append(encoder.fit(spark.createDataFrame(largest, [f"_code_{v}" for v in vectors])))
        return found

    def flags(self, df: DataFrame, column: str, values: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
        """One-hot columns of stated categories of a column, whatever their number in all."""
        sql = next((d.text for d in self.dictionaries if d.column == column), f"CAST({_name(column)} AS STRING)")
        named = [f"CAST({sql} <=> {_text(v)} AS DOUBLE) AS {_name(f'cat__{column}_{v}'.replace('.', '_'))}" for v in values]
        return df.selectExpr(*[_name(c) for c in keep], *named)


@dataclass(frozen=True)
class Preprocessor:
    """How to turn columns into features.

    Output order: numeric, categorical, passthrough, then the columns named nowhere. These stay unless ``drop`` is
    given; then all of them go. With ``approximate`` medians and quartiles come from a sketch.
    """

    numeric: Sequence[str] = ()
    categorical: Sequence[str] = ()
    numeric_strategy: str = "standard"
    categorical_strategy: str = "onehot"
    missing_strategy: str = "mean"
    fill_value: Any = None
    passthrough: Sequence[str] = ()
    drop: Sequence[str] = ()
    approximate: bool = False
    #: Columns with more categories keep them in a table.
    max_categories: int = 10_000

    def __post_init__(self):
        for kind, value, known in (
            ("numeric", self.numeric_strategy, NUMERIC),
            ("categorical", self.categorical_strategy, CATEGORICAL),
            ("missing", self.missing_strategy, MISSING),
        ):
            if value not in known:
                raise ValueError(f"Unknown {kind} strategy: {value}")

    def fit(self, df: DataFrame, exclude: Sequence[str] = ()) -> FittedPreprocessor:
        """Learn from ``df``; ``exclude`` names columns that are no features, such as key and label."""
        return self._fitted(df, exclude)

    def _fitted(self, df: DataFrame, exclude: Sequence[str], moments=None, found=None) -> FittedPreprocessor:
        listed = [*self.numeric, *self.categorical, *self.passthrough]
        outputs: list[tuple[str, str]] = []
        dictionaries: list[Dictionary] = []
        if self.numeric:
            outputs += self._numeric(df, moments)
        if self.categorical:
            outputs += self._categorical(df, dictionaries, found)
        outputs += [(f"pass__{c}", _name(c)) for c in self.passthrough]
        if not self.drop:
            rest = [c for c in df.columns if c not in listed and c not in exclude]
            outputs += [(f"remainder__{c}" if listed else c, _name(c)) for c in rest]
        return FittedPreprocessor(tuple(_distinct_names(outputs)), tuple(dictionaries))

    def fit_unions(
        self, df: DataFrame, part: str, unions: Sequence[Collection[int]], exclude: Sequence[str] = ()
    ) -> list[FittedPreprocessor]:
        """Fit on several unions of the parts of ``df``, numbered in the column ``part``, from one pass over it.

        Counts, moments, extremes and category counts of the parts add up to those of a union. Quantiles and the commonest
        number don't, nor do categories that need a dictionary; then each union is fitted by itself.
        """
        adds_up = self.numeric_strategy != "robust" and self.missing_strategy in ("mean", "constant", "none")
        counts: list[tuple[int, str, str | None, int]] = []
        if adds_up and self.categorical and self.categorical_strategy != "none":
            tables = materialize(_value_counts(df, self.categorical, [part]), "categories")
            sizes = tables.groupBy("column").agg(F.count_distinct("value").alias("n")).collect()
            adds_up = all(r["n"] <= self.max_categories for r in sizes)
            counts = [tuple(r) for r in tables.collect()] if adds_up else []
        if not adds_up and (self.numeric or self.categorical):
            return [self.fit(df.where(F.col(part).isin(*sorted(u))).drop(part), exclude) for u in unions]
        seen: dict[int, tuple[int, dict[str, list]]] = {}
        if self.numeric and self.numeric_strategy != "none":
            seen = self._moments(df.selectExpr(*self._raw(), _name(part)), [part])
        fitted = []
        for union in unions:
            known: dict[str, dict] = {c: {} for c in self.categorical}
            for number, c, value, n in counts:
                if number in union:
                    known[c][value] = known[c].get(value, 0) + n
            found = {c: list(values.items()) for c, values in known.items()}
            fitted.append(self._fitted(df.drop(part), exclude, _together([v for k, v in seen.items() if k in union]), found))
        return fitted

    # Numeric columns

    def _raw(self) -> list[str]:
        """The numeric columns as doubles; NaN counts as missing."""
        return [f"{_double(c)} AS {_name(c)}" for c in self.numeric]

    def _moments(self, df: DataFrame, by: Sequence[str] = ()) -> dict:
        """Per group (None without ``by``): rows, and count, mean, variance and extremes of each numeric column."""
        stats = (F.count, F.avg, F.var_pop, F.min, F.max)
        found = df.groupBy(*by).agg(
            F.count("*").alias("_rows"),
            *[s(F.col(c)).alias(f"_{i}_{k}") for k, c in enumerate(self.numeric) for i, s in enumerate(stats)],
        )
        return {
            (r[by[0]] if by else None): (
                r["_rows"], {c: [r[f"_{i}_{k}"] for i in range(len(stats))] for k, c in enumerate(self.numeric)}
            )
            for r in found.collect()
        }

    def _quantiles(self, df: DataFrame, columns: Sequence[str], shares: Sequence[float]):
        return (approximate_quantiles if self.approximate else exact_quantiles)(df, columns, shares)

    def _fills(self, df: DataFrame, means: dict[str, float]) -> dict[str, float]:
        """The value each numeric column's nulls get."""
        if self.missing_strategy == "mean":
            return means
        if self.missing_strategy == "median":
            return {c: q[0] for c, q in self._quantiles(df, self.numeric, [0.5]).items()}
        if self.missing_strategy == "constant":
            return dict.fromkeys(self.numeric, 0.0 if self.fill_value is None else float(self.fill_value))
        return {c: float(v) for c, v in most_frequent(df, self.numeric).items() if v is not None}

    def _numeric(self, df: DataFrame, moments: tuple[int, dict[str, list]] | None = None) -> list[tuple[str, str]]:
        if self.numeric_strategy == "none":
            return [(f"num__{c}", _name(c)) for c in self.numeric]
        raw = {c: _double(c) for c in self.numeric}
        df = df.selectExpr(*self._raw())
        rows, seen = moments or self._moments(df)[None]
        impute = self.missing_strategy != "none"
        fills = self._fills(df, {c: s[1] for c, s in seen.items()}) if impute else {}
        filled = {
            c: f"coalesce({raw[c]}, {_number(fills[c])})" if fills.get(c) is not None else raw[c] for c in self.numeric
        }
        if self.numeric_strategy == "robust":
            full = df.fillna({c: v for c, v in fills.items() if v is not None}) if fills else df
            quartiles = self._quantiles(full, self.numeric, [0.25, 0.5, 0.75])
            middle = {c: (q[1], q[2] - q[0]) if q[1] is not None else (0.0, 1.0) for c, q in quartiles.items()}
        else:
            middle = {c: self._shift(rows, seen[c], fills.get(c)) for c in self.numeric}
        return [
            (f"num__{c}", f"({filled[c]} - {_number(middle[c][0])}) / {_number(middle[c][1] or 1.0)}")
            for c in self.numeric
        ]

    def _shift(self, rows: int, seen: Sequence, fill: float | None) -> tuple[float, float]:
        """What to subtract and divide by, for the column with its nulls filled; no second pass is needed."""
        known, mean, variance, low, high = seen
        if not known:
            return (fill or 0.0, 1.0)
        gaps = rows - known if fill is not None else 0
        if self.numeric_strategy == "minmax":
            if gaps:
                low, high = min(low, fill), max(high, fill)
            return low, high - low
        total = known + gaps
        centre = mean + gaps * (fill - mean) / total if gaps else mean
        spread = known * (variance + (mean - centre) ** 2)
        if gaps:
            spread += gaps * (fill - centre) ** 2
        return centre, math.sqrt(spread / total)

    # Categorical columns

    def _categorical(
        self, df: DataFrame, dictionaries: list[Dictionary], found: dict[str, list] | None = None
    ) -> list[tuple[str, str]]:
        if self.categorical_strategy == "none":
            return [(f"cat__{c}", _name(c)) for c in self.categorical]
        large: list[str] = []
        if found is None:
            counts = materialize(_value_counts(df, self.categorical), "categories")
            sizes = {r["column"]: r["n"] for r in counts.groupBy("column").agg(F.count("value").alias("n")).collect()}
            large = [c for c in self.categorical if sizes.get(c, 0) > self.max_categories]
            path = _numbered(df, counts, large) if large else ""
            found = {c: [] for c in self.categorical}
            # At most ``max_categories`` rows for each column.
            for r in counts.where(~F.col("column").isin(*large) if large else F.lit(True)).collect():
                found[r["column"]].append((r["value"], r["n"]))
        impute = self.missing_strategy != "none"
        outputs = []
        for c in self.categorical:
            sql = f"CAST({_name(c)} AS STRING)"
            if c in large:
                dictionaries.append(self._looked_up(df, counts, c, sql, sizes[c], path, len(dictionaries)))
                outputs.append((f"cat__{c}", dictionaries[-1].code))
                continue
            order = _native_order(df, c)
            known = sorted((v for v, _ in found[c] if v is not None), key=order)
            if impute and known:
                tallies = dict(found[c])
                mode = min(known, key=lambda v: (-tallies[v], order(v)))
                sql = f"coalesce({sql}, {_text(mode)})"
            has_null = not impute and any(v is None for v, _ in found[c])
            outputs += self._encoded(c, sql, known, has_null)
        return outputs

    def _looked_up(self, df: DataFrame, counts: DataFrame, c: str, sql: str, n: int, path: str, i: int) -> Dictionary:
        """A column whose categories are a table."""
        has_null = False
        if self.missing_strategy != "none":
            mode = most_frequent(df, [c], counts.where(F.col("column") == c))[c]
            sql = f"coalesce({sql}, {_text(mode)})"
        else:
            has_null = bool(counts.where((F.col("column") == c) & F.col("value").isNull()).limit(1).count())
        if self.categorical_strategy == "ordinal":
            return Dictionary(c, path, sql, f"CASE WHEN {sql} IS NOT NULL THEN coalesce(CAST(_code_{i} AS DOUBLE), -1D) END")
        size = n + has_null
        unknown = f"coalesce(CAST(_code_{i} AS DOUBLE), {size}D)"
        return Dictionary(c, path, sql, f"CASE WHEN {sql} IS NULL THEN {n}D ELSE {unknown} END", size)

    def _encoded(self, c: str, sql: str, known: list[str], has_null: bool) -> list[tuple[str, str]]:
        if self.categorical_strategy == "ordinal":
            if not known:
                return [(f"cat__{c}", f"CASE WHEN {sql} IS NOT NULL THEN -1D END")]
            codes = ", ".join(f"{_text(v)}, {i}D" for i, v in enumerate(known))
            code = f"coalesce(element_at(map({codes}), {sql}), -1D)"
            return [(f"cat__{c}", f"CASE WHEN {sql} IS NOT NULL THEN {code} END")]
        flags = [(f"cat__{c}_{v}".replace(".", "_"), f"CAST({sql} <=> {_text(v)} AS DOUBLE)") for v in known]
        if has_null:
            flags.append((f"cat__{c}_None", f"CAST({sql} IS NULL AS DOUBLE)"))
        if self.categorical_strategy == "binary" and len(flags) == 2:
            return flags[1:]
        return flags


def _distinct_names(outputs: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Categories that differ only in a character names cannot hold get a number."""
    seen: dict[str, int] = {}
    result = []
    for name, sql in outputs:
        seen[name] = seen.get(name, 0) + 1
        result.append((name if seen[name] == 1 else f"{name}_{seen[name]}", sql))
    return result


def _native_order(df: DataFrame, column: str):
    """Sort key for category texts: numbers as numbers."""
    return float if isinstance(df.schema[column].dataType, NumericType) else str


def _value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows per (column, value as text) for several columns in one pass."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return (
        df.select(*by, F.explode(F.array(*pairs)).alias("p"))
        .groupBy(*by, "p.column", "p.value")
        .agg(F.count("*").alias("n"))
        .select(*by, "column", "value", "n")
    )


def _together(parts: Sequence[tuple[int, dict[str, list]]]) -> tuple[int, dict[str, list]] | None:
    """Moments of parts as those of their union."""
    if not parts:
        return None
    result = {}
    for c in parts[0][1]:
        own = [seen[c] for _, seen in parts if seen[c][0]]
        n = sum(s[0] for s in own)
        if not n:
            result[c] = [0, None, None, None, None]
            continue
        mean = sum(s[0] * s[1] for s in own) / n
        variance = sum(s[0] * (s[2] + (s[1] - mean) ** 2) for s in own) / n
        result[c] = [n, mean, variance, min(s[3] for s in own), max(s[4] for s in own)]
    return sum(rows for rows, _ in parts), result


def _numbered(df: DataFrame, counts: DataFrame, columns: Sequence[str]) -> str:
    """Where the categories of some columns are stored with their codes 0..n-1, in the order of the column's own type."""
    path = new_path(df.sparkSession, "dictionary")
    for c in columns:
        values = counts.where((F.col("column") == c) & F.col("value").isNotNull()).select("value")
        order = [F.col("value").cast("double"), "value"] if _native_order(df, c) is float else ["value"]
        numbered = with_position(values, order, "code").withColumn("column", F.lit(c))
        numbered.write.mode("append").partitionBy("column").parquet(path)
    return path


def most_frequent(df: DataFrame, columns: Sequence[str], counts: DataFrame | None = None) -> dict[str, str | None]:
    """The commonest value of each column as text, the smallest on a tie, nulls ignored."""
    counts = _value_counts(df, columns) if counts is None else counts
    numbers = F.when(F.col("column").isin(*[c for c in columns if _native_order(df, c) is float] or [""]), F.col("value"))
    first = F.min(F.struct((-F.col("n")).alias("n"), numbers.try_cast("double").alias("as_number"), "value"))
    rows = counts.where(F.col("value").isNotNull()).groupBy("column").agg(first.alias("top")).collect()
    result: dict[str, str | None] = dict.fromkeys(columns)
    result.update({r["column"]: r["top"]["value"] for r in rows})
    return result


def label_encode(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Replace text and timestamp columns by the rank 0..n-1 of their text among the distinct texts.

    Works for any number of distinct values: they are numbered across the cluster and joined back.
    """
    kinds = (StringType, TimestampType, TimestampNTZType)
    chosen = list(columns or [f.name for f in df.schema if isinstance(f.dataType, kinds)])
    result = df
    for c in chosen:
        text = F.coalesce(F.col(c).cast("string"), F.lit("None"))
        codes = with_position(df.select(text.alias("_text")).distinct(), ["_text"], "_code")
        result = (
            result.withColumn("_text", text)
            .join(codes, "_text")
            .withColumn(c, F.col("_code"))
            .drop("_text", "_code")
        )
    return result.select(*df.columns)
