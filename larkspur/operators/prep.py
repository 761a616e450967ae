"""Validation, renaming, casting, label mapping and null reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from larkspur.functions.columns import is_missing, map_label, spark_type


@dataclass(frozen=True)
class FeatureSpec:
    """Declared input columns. Each feature is ``{name, alias, dtype}``; the target also has ``mapping``."""

    keys: Sequence[str]
    numeric: Sequence[Mapping]
    categorical: Sequence[Mapping]
    target: Mapping

    def _all(self) -> list[Mapping]:
        return [*self.numeric, *self.categorical, self.target]

    def required(self) -> list[str]:
        return [*self.keys, *[f["name"] for f in self._all()]]

    def renames(self) -> dict[str, str]:
        return {f["name"]: f["alias"] for f in self._all() if f.get("alias", f["name"]) != f["name"]}

    def casts(self) -> dict[str, str]:
        """Alias -> Spark type of every feature; the target is mapped instead."""
        return {f.get("alias", f["name"]): spark_type(f["dtype"]) for f in (*self.numeric, *self.categorical)}

    @property
    def target_name(self) -> str:
        return self.target.get("alias", self.target["name"])


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns the table lacks; reads the schema only."""
    return [c for c in required if c not in df.columns]


def validate_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"Missing columns: {missing}")
    return df


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def cast_columns(df: DataFrame, types: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Cast in one projection. Strict: a bad or out-of-range value fails the query. Otherwise it becomes null."""
    casts = {c: (F.col(c).cast(t) if strict else _lenient(df, c, t)) for c, t in types.items()}
    return df.withColumns(casts)


# Whole numbers a type holds.
_RANGES = {"tinyint": 2**7, "smallint": 2**15, "int": 2**31, "bigint": 2**63}
_WHOLE, _NUMBER = r"^\s*[+-]?[0-9]+\s*$", r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_NAMED = r"(?i)^\s*([+-]?(inf|infinity)|nan)\s*$"


def _lenient(df: DataFrame, column: str, kind: str) -> Column:
    """A cast that gives null where it can't be done. What can be told beforehand is tested first: a failing cast costs an
    exception for each row."""
    col, source = F.col(column), df.schema[column].dataType
    limit = _RANGES.get(kind)
    if isinstance(source, StringType) and limit:
        # Fewer digits than the largest number has always fit; the few others are left to the cast.
        return F.when(col.rlike(_WHOLE), col.try_cast(kind))
    if isinstance(source, StringType) and kind in ("double", "float"):
        return F.when(col.rlike(_NUMBER) | col.rlike(_NAMED), col.try_cast(kind))
    if isinstance(source, NumericType) and limit:
        number = col.cast("double") if kind != "bigint" else col
        return F.when((number > float(-limit - 1)) & (number < float(limit)), col.try_cast(kind))
    return col.try_cast(kind)


def cast_rejects(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Per column, how many non-null values a lenient cast turns into null."""
    row = df.agg(
        *[F.count_if(F.col(c).isNotNull() & _lenient(df, c, t).isNull()).alias(c) for c, t in types.items()]
    )
    return _unpivot(row, list(types), "rejected")


def map_target(df: DataFrame, column: str, mapping: Mapping[str, int]) -> DataFrame:
    return df.withColumn(column, map_label(F.col(column), mapping))


def _unpivot(row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(value)) for c in columns]
    return row.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def null_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: null count (with NaN), percent of all rows, and the row total. One pass for all columns."""
    columns = list(columns or df.columns)
    row = df.agg(F.count("*").alias("_rows"), *[F.count_if(is_missing(df, c)).alias(c) for c in columns])
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("nulls")) for c in columns]
    return (
        row.select("_rows", F.explode(F.array(*pairs)).alias("p"))
        .select("p.column", "p.nulls", F.col("_rows").alias("rows"))
        .withColumn("percent", F.when(F.col("rows") > 0, 100.0 * F.col("nulls") / F.col("rows")).otherwise(0.0))
    )


def check_nulls(df: DataFrame, max_null_fraction: float = 0.0, raise_error: bool = True) -> list[str]:
    """Columns with a larger share of nulls than allowed; by default a single null offends."""
    bad = null_report(df).where(F.col("percent") > 100.0 * max_null_fraction).collect()
    if bad and raise_error:
        found = ", ".join(f"{r['column']}: {r['nulls']} of {r['rows']}" for r in bad)
        raise ValueError(f"Unexpected null values found. {found}")
    return [r["column"] for r in bad]


def apply_custom(df: DataFrame, custom: object | Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Run a caller's step: a function on DataFrames, or an object with ``apply_transformations``.

    An object without that method is skipped with a warning.
    """
    step = getattr(custom, "apply_transformations", None) or (custom if callable(custom) else None)
    if step is None:
        if custom is not None:
            import warnings

            warnings.warn("custom step has no apply_transformations method; skipped", stacklevel=2)
        return df
    return df.transform(step)


def prepare(df: DataFrame, spec: FeatureSpec, custom=None, check: bool = True) -> DataFrame:
    """Validate, rename, cast and map, run the custom step, then check for nulls. Only the null check runs a job."""
    result = (
        df.transform(validate_columns, spec.required())
        .transform(rename_columns, spec.renames())
        .transform(cast_columns, spec.casts())
        .transform(map_target, spec.target_name, spec.target["mapping"])
        .transform(apply_custom, custom)
    )
    if check:
        check_nulls(result)
    return result


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_incomplete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows with a null or NaN in any of the columns.

    One condition per column, so that each moves as far down as it can and turns an outer join into an inner one.
    """
    return reduce(DataFrame.where, [F.col(c).isNotNull() & ~is_missing(df, c) for c in columns], df)


def first_rows(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The first n rows in a stated order, so that the result does not depend on the partitioning."""
    return df.orderBy(*order).limit(n)
