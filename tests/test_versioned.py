"""Versioned tables: feeds against snapshots, merges that die, two writers, old versions."""

import pytest
from pyspark.sql import functions as F

from larkspur.operators.feature_table import change_feed
from larkspur.operators.versioned import VersionedTable


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def table(spark, tmp_path):
    made = VersionedTable(spark, str(tmp_path / "t"))
    made.create(spark.range(100).select("id", (F.col("id") * 2).alias("a"), F.lit("x").alias("b")), ["id"], buckets=4)
    return made


def widened(df, like):
    return df.withColumns({c: F.lit(None).cast(like.schema[c].dataType) for c in like.columns if c not in df.columns})


def test_feed_equals_snapshots(spark, table):
    """Three merges and a delete: new keys, a new column, changes that cancel out, an update that changes nothing."""
    small = spark.range(90, 110).select("id", F.lit(5).alias("a"))
    assert table.merge(small) == 2
    assert table.merge(spark.range(3).select("id", F.lit(1.5).alias("c"))) == 3
    assert table.merge(spark.range(90, 100).select("id", (F.col("id") * 2).alias("a"))) == 4
    assert table.delete(spark.range(50, 53).union(spark.range(900, 910))) == 5
    assert table.merge(spark.range(3).select("id", F.lit(1.5).alias("c"))) == 5  # nothing new
    for first in range(6):
        for last in range(max(first, 1), 6):
            new = table.read(last)
            old = widened(table.read(first) if first else new.limit(0), new)
            assert rows(table.changes_between(first, last)) == rows(change_feed(old, new, ["id"])), (first, last)
    assert table.change_log(1, 5).groupBy("_version").count().orderBy("_version").collect() == [(2, 30), (3, 6), (4, 20), (5, 3)]
    assert table.history().count() == 5 and table.read().count() == 107


def test_a_merge_that_dies_is_not_seen(spark, table, monkeypatch):
    before = rows(table.read())

    def dies(*_args, **_kwargs):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "_publish", dies)
        with pytest.raises(OSError, match="lost"):
            table.merge(spark.range(5).select("id", F.lit(7).alias("a")))
    assert table.versions() == [1] and rows(table.read()) == before
    assert table.merge(spark.range(5).select("id", F.lit(7).alias("a"))) == 2
    assert table.read().where("a = 7").count() == 5 and rows(table.read(1)) == before
    # The dead merge left a folder that no version names.
    assert len(table.vacuum(2)) == 2 and rows(table.read(1)) == before and table.read().count() == 100


def test_two_writers_of_one_version(spark, table, tmp_path):
    other, now = VersionedTable(spark, str(tmp_path / "t")), table.commit()
    other.merge(spark.range(1).select("id", F.lit(1).alias("a")))
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish(2, "merge", now)
    assert table.versions() == [1, 2] and not [n for n in table.folder.names("log") if n.endswith("draft")]


def test_only_touched_buckets_are_written(spark, table):
    table.merge(spark.range(1).select("id", F.lit(-1).alias("a")))
    first, second = table.commit(1).files, table.commit(2).files
    assert sum(first[b] != second[b] for b in first) == 1


def test_keys_versions_and_empty_tables(spark, table, tmp_path):
    with pytest.raises(ValueError, match="no version 9"):
        table.read(9)
    with pytest.raises(Exception, match="null in the key"):
        table.merge(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 1L AS a"))
    with pytest.raises(ValueError, match="null or repeats"):
        VersionedTable(spark, str(tmp_path / "u")).create(spark.range(3).union(spark.range(1)).withColumn("a", F.lit(1)), ["id"])
    with pytest.raises(ValueError, match="besides its key"):
        VersionedTable(spark, str(tmp_path / "u")).create(spark.range(3), ["id"])
    # Keys of another type meet the stored ones; the last update by the given order counts.
    updates = spark.sql("SELECT * FROM VALUES ('3', 10L, 2), ('3', 11L, 1) AS v(id, a, at)")
    table.merge(updates, order=["at"])
    assert table.read().where("id = 3").select("a").collect() == [(10,)]
    empty = VersionedTable(spark, str(tmp_path / "e"))
    two = spark.range(2).withColumn("a", F.lit(1))
    empty.create(two.limit(0), ["id"], buckets=2)
    assert empty.read().count() == 0 and empty.merge(two) == 2 and empty.read().count() == 2
    empty.delete(spark.range(2))
    assert empty.read().count() == 0 and empty.changes_between(1, 3).count() == 0 and empty.read(2).count() == 2
