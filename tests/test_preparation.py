"""Validation, renaming, casts, label map, null checks, CSV, and the preparation flow."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from larkspur.operators import prep
from larkspur.plans.preparation import prepare_and_split, prepare_tables
from larkspur.sources import catalog, files
from larkspur.workspace import new_path, scratch_database

# Parcels: weight in grams and postage in cents as text, a size letter, a zone number, and whether they came back.
ROWS = [(11, "250", "395", "S", 4, "kept"), (12, "1900", "870", "L", 7, "returned"), (13, "640", "520", "M", 4, "kept"),
        (14, "75", "160", "S", 1, "returned")]
TYPE = "parcel int, grams string, cents string, size string, zone bigint, fate string"
SPEC = prep.FeatureSpec(
    keys=["parcel"],
    numeric=[
        {"name": "grams", "alias": "weight", "dtype": "int32"},
        {"name": "cents", "alias": "postage", "dtype": "int32"},
    ],
    categorical=[
        {"name": "size", "alias": "size", "dtype": "category"},
        {"name": "zone", "alias": "zone", "dtype": "category"},
    ],
    target={"name": "fate", "alias": "fate", "dtype": "int32", "mapping": {"kept": 3, "returned": 8}},
)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, TYPE)


def test_missing_column_raises(rows):
    with pytest.raises(ValueError, match="Missing columns: .*grams"):
        prep.validate_columns(rows.drop("grams"), SPEC.required())


def test_the_key_is_required(rows):
    assert prep.missing_columns(rows.drop("parcel"), SPEC.required()) == ["parcel"]


def test_rename(rows):
    renamed = set(prep.rename_columns(rows, SPEC.renames()).columns)
    assert {"weight", "postage"} <= renamed and not {"grams", "cents"} & renamed


def test_prepared_values(rows):
    got = {r["parcel"]: r for r in prep.prepare(rows, SPEC).collect()}
    assert (got[12]["weight"], got[12]["postage"], got[12]["zone"], got[12]["fate"]) == (1900, 870, "7", 8)
    assert sum(r["weight"] for r in got.values()) == 2865
    assert [got[p]["fate"] for p in (11, 13, 14)] == [3, 3, 8]


def test_bad_value_fails_or_is_reported(rows):
    bad = rows.withColumn("grams", F.when(F.col("parcel") > 11, "heavy").otherwise(F.col("grams")))
    with pytest.raises(PySparkException):
        prep.cast_columns(bad, {"grams": "int"}).collect()
    lenient = prep.cast_columns(bad, {"grams": "int"}, strict=False)
    assert lenient.where("grams IS NULL").count() == 3
    assert prep.cast_rejects(bad, {"grams": "int"}).first()["rejected"] == 3


def test_lenient_casts_give_what_the_cast_gives(spark):
    texts = ["1", " -7 ", "+3", "1.5", "abc", "", "128", "-129", "99999999999", "1e3", ".5", "nan", "Infinity", None]
    rows = spark.createDataFrame([(t,) for t in texts], "x string")
    for kind in ("tinyint", "int", "bigint", "double"):
        both = prep.cast_columns(rows.withColumn("y", F.col("x").try_cast(kind)), {"x": kind}, strict=False)
        assert both.where("NOT x <=> y").count() == 0, kind
    numbers = spark.createDataFrame([(x,) for x in (0.0, -1.9, 127.9, 128.0, -128.9, 1e30, float("nan"), None)], "x double")
    for kind in ("tinyint", "smallint", "int", "bigint"):
        both = prep.cast_columns(numbers.withColumn("y", F.col("x").try_cast(kind)), {"x": kind}, strict=False)
        assert both.where("NOT x <=> y").count() == 0, kind


def test_unmapped_label_is_a_null_and_offends(rows):
    odd = rows.withColumn("fate", F.when(F.col("parcel") == 13, "lost").otherwise(F.col("fate")))
    with pytest.raises(ValueError, match="fate: 1 of 4"):
        prep.prepare(odd, SPEC)
    assert prep.check_nulls(prep.prepare(odd, SPEC, check=False), raise_error=False) == ["fate"]
    assert prep.check_nulls(prep.prepare(odd, SPEC, check=False), max_null_fraction=0.5) == []


def test_nan_counts_as_null(spark):
    rows = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    assert prep.null_report(rows).first()["nulls"] == 2
    assert prep.drop_incomplete(rows, ["x"]).count() == 1


def test_custom_step(rows):
    class Dearest:
        def apply_transformations(self, df):
            return df.withColumn("dearest", F.greatest("weight", "postage"))

    assert prep.prepare(rows, SPEC, Dearest()).agg(F.sum("dearest")).first()[0] == 395 + 1900 + 640 + 160
    with pytest.warns(UserWarning, match="skipped"):
        assert prep.prepare(rows, SPEC, object()).columns == prep.prepare(rows, SPEC).columns


def test_small_table_splits(rows):
    train, test = prepare_and_split(rows, SPEC, 0.25, 42)
    assert (train.count(), test.count()) == (3, 1)
    assert train.join(test, "parcel").count() == 0


def test_csv_round_trip(spark):
    path = new_path(spark, "csv")
    spark.createDataFrame([(1, 10), (2, 20), (3, 30), (4, 40), (5, 50)], "A int, B int").write.csv(path, header=True)
    for df in (files.read_csv(spark, path), files.read_csv(spark, path, "A int, B int")):
        assert df.columns == ["A", "B"]
        assert sorted(map(tuple, df.collect())) == [(1, 10), (2, 20), (3, 30), (4, 40), (5, 50)]


def test_parameters_are_values_not_text(spark):
    got = catalog.read_sql(spark, "SELECT :a AS x, ${ab} AS y", {"a": "1 OR 1=1", "ab": 2}).first()
    assert tuple(got) == ("1 OR 1=1", 2)


def test_prepare_tables(spark, rows):
    path, base = new_path(spark, "csv"), scratch_database(spark)
    rows.write.csv(path, header=True)
    for _ in range(2):
        prepare_tables(spark, path, TYPE, SPEC, f"{base}.train", f"{base}.test", at="2024-01-01 00:00:00")
    assert (spark.table(f"{base}.train").count(), spark.table(f"{base}.test").count()) == (6, 2)
    assert "update_timestamp_utc" in spark.table(f"{base}.test").columns
