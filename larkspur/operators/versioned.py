"""Feature tables with versions: upserts that readers see whole or not at all, old versions, and a change feed.

A table is a folder. ``log`` has one small file per version: the schema, and for each key bucket the folder that holds its
rows. A merge writes the buckets it changes and its change rows to folders of their own, and then publishes the next version
by renaming one file to a name that must not exist yet. So a reader sees the version before or after, a merge that dies leaves
nothing but unread files, and of two writers of the same version one fails. Change rows are kept per version;
changes between two versions are read from them, not from the rows of the table.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from larkspur.operators.feature_table import (
    BUCKET, _bucketed, _complete, _typed, as_changes, check_keys, latest_per_key,
)
from larkspur.workspace import materialize

VERSION = "_version"


@dataclass(frozen=True)
class Commit:
    """One version. ``files`` names the data folder of each bucket that has rows; ``changes`` the folder of change rows."""

    version: int
    kind: str
    at_millis: int
    keys: list[str]
    buckets: int
    schema: dict
    files: dict[str, str]
    changes: str | None
    #: What a user of the table keeps with a version.
    notes: dict

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(self.schema)


class Folder:
    """Small files of a shared folder, on any file system Spark knows."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.path = path.rstrip("/")

    def _at(self, name: str = ""):
        path = self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path, path.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        path, fs = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []

    def read(self, name: str) -> str:
        path, fs = self._at(name)
        stream = fs.open(path)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a file under a name that must not exist: readers see all of it or nothing."""
        draft, fs = self._at(f"{name}.{uuid.uuid4().hex}.draft")
        out = fs.create(draft, False)
        out.write(bytearray(text, "utf-8"))
        out.close()
        target, _ = self._at(name)
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        rename = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self._jvm.java.lang.reflect.Array.newInstance(rename.NONE.getClass(), 1)
        options[0] = rename.NONE
        try:
            files.rename(files.makeQualified(draft), files.makeQualified(target), options)
        except Exception as error:
            fs.delete(draft, False)
            if fs.exists(target):
                raise RuntimeError(f"{name} was published by another writer") from error
            raise

    def delete(self, name: str) -> None:
        path, fs = self._at(name)
        fs.delete(path, True)


class VersionedTable:
    """A keyed table in a folder; every change makes the next version, counted from 1."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    # Versions

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.folder.names("log") if n.endswith(".json")]

    def commit(self, version: int | None = None) -> Commit:
        """What is stated of a version, by default the last one."""
        known = self.versions()
        if not known or (version is not None and version not in known):
            raise ValueError(f"{self.folder.path} has no version {version if known else 'yet'}")
        return Commit(**json.loads(self.folder.read(f"log/{known[-1] if version is None else version:012d}.json")))

    def history(self) -> DataFrame:
        """A row per version."""
        rows = [(c.version, c.kind, c.at_millis, len(c.files)) for c in map(self.commit, self.versions())]
        return self.spark.createDataFrame(rows, "version long, kind string, at_millis long, buckets_with_rows int")

    def _publish(self, version: int, kind: str, before: Commit | None, **stated) -> int:
        fields = {**(asdict(before) if before else {"notes": {}}), **stated}
        fields |= {"version": version, "kind": kind, "at_millis": int(time.time() * 1000)}
        self.folder.publish(f"log/{version:012d}.json", json.dumps(asdict(Commit(**fields))))
        return version

    # Rows

    def _rows(self, commit: Commit, schema: StructType | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        schema = schema or commit.struct
        wanted = commit.files if buckets is None else {str(b): commit.files[str(b)] for b in buckets if str(b) in commit.files}
        paths = [f"{self.folder.path}/{folder}/{BUCKET}={bucket}" for bucket, folder in sorted(wanted.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version."""
        return self._rows(self.commit(version))

    def create(self, df: DataFrame, keys: Sequence[str], schema: StructType | None = None, buckets: int = 64) -> int:
        """Cast to the declared schema, check the key, write version 1."""
        typed = df if schema is None else df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
        if set(typed.columns) <= set(keys):
            raise ValueError("a table needs a column besides its key")
        check_keys(typed, keys)
        folder, files = self._write(_bucketed(typed, keys, buckets))
        nullable = StructType([StructField(f.name, f.dataType) for f in typed.schema])
        return self._publish(
            1, "create", None, keys=list(keys), buckets=buckets, schema=json.loads(nullable.json()),
            files={str(b): folder for b in files}, changes=None,
        )

    def _write(self, rows: DataFrame) -> tuple[str, list[int]]:
        """Write rows by bucket; the folder and the buckets it holds (no more than the table has)."""
        folder = f"data/{uuid.uuid4().hex}"
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.folder.path}/{folder}")
        names = self.folder.names(folder)
        return folder, [int(n.split("=")[1]) for n in names if n.startswith(f"{BUCKET}=")]

    # Changes

    def merge(self, updates: DataFrame, order: Sequence[str] = (), notes: dict | None = None) -> int:
        """Replace rows with known keys, add the others; returns the version that holds them.

        Of several updates of a key the last by ``order`` counts. A column the updates lack keeps its value, a new one is
        added. Only buckets with a real change are written; without any there is no new version.
        """
        now = self.commit()
        known = [f.name for f in now.struct if f.name in updates.columns]
        typed = _complete(_typed(updates, now.struct, known), now.keys)
        latest = materialize(_bucketed(latest_per_key(typed, now.keys, order), now.keys, now.buckets), "updates")
        added = [StructField(f.name, f.dataType) for f in latest.schema if f.name not in {*now.struct.names, BUCKET}]
        wide = StructType([*now.struct.fields, *added])
        rest = [c for c in wide.names if c not in now.keys]
        mine = F.struct(*[(F.col(f"_new.{c}") if c in latest.columns else F.col(f"_before.{c}")).alias(c) for c in rest])
        new = latest.select(*now.keys, BUCKET, F.struct(*[c for c in rest if c in latest.columns]).alias("_new"))
        joined = new.join(self._images(now, wide, latest), now.keys, "left").withColumn("_after", mine)
        return self._change("merge", now, wide, joined.where(~F.col("_after").eqNullSafe(F.col("_before"))), notes)

    def delete(self, keys: DataFrame) -> int:
        """Remove the rows of these keys; returns the version without them."""
        now = self.commit()
        gone = _bucketed(_typed(keys.select(*now.keys), now.struct, now.keys).distinct(), now.keys, now.buckets)
        gone = materialize(gone, "gone")
        found = gone.join(self._images(now, now.struct, gone), now.keys)
        nothing = F.lit(None).cast(found.schema["_before"].dataType)
        return self._change("delete", now, now.struct, found.withColumn("_after", nothing))

    def _images(self, now: Commit, schema: StructType, touching: DataFrame) -> DataFrame:
        """Keys and other columns of the buckets that some rows touch."""
        buckets = [r[0] for r in touching.select(BUCKET).distinct().collect()]
        rest = [c for c in schema.names if c not in now.keys]
        return self._rows(now, schema, buckets).select(*now.keys, F.struct(*rest).alias("_before"))

    def _change(self, kind: str, now: Commit, schema: StructType, changes: DataFrame, notes: dict | None = None) -> int:
        folder = f"changes/{uuid.uuid4().hex}"
        written = changes.select(F.lit(now.version + 1).cast("long").alias(VERSION), *now.keys, "_before", "_after", BUCKET)
        written.write.parquet(f"{self.folder.path}/{folder}")
        written = self.spark.read.schema(written.schema).parquet(f"{self.folder.path}/{folder}")
        touched = [r[0] for r in written.select(BUCKET).distinct().collect()]
        if not touched and notes is None:
            return now.version
        files = dict(now.files)
        if touched:
            kept = _bucketed(self._rows(now, schema, touched), now.keys, now.buckets)
            kept = kept.join(written.select(*now.keys), now.keys, "left_anti")
            new = written.where(F.col("_after").isNotNull()).select(*now.keys, "_after.*", BUCKET)
            data, filled = self._write(kept.unionByName(new).select(*schema.names, BUCKET))
            files = {b: f for b, f in files.items() if int(b) not in touched} | {str(b): data for b in filled}
        return self._publish(
            now.version + 1, kind, now, schema=json.loads(schema.json()), files=files,
            changes=folder if touched else None, notes=notes or now.notes,
        )

    def change_rows(self, first: int, last: int) -> DataFrame:
        """Every change after version ``first`` up to ``last``: version, keys, and the row before and after."""
        end = self.commit(last)
        rest = StructType([f for f in end.struct if f.name not in end.keys])
        kinds = [StructField(VERSION, LongType()), *[f for f in end.struct if f.name in end.keys]]
        schema = StructType([*kinds, StructField("_before", rest), StructField("_after", rest)])
        commits = [self.commit(v) for v in self.versions() if first < v <= last]
        paths = [f"{self.folder.path}/{c.changes}" for c in commits if c.changes]
        found = self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        if first < 1 <= last:
            rows = self._rows(self.commit(1), end.struct)
            made = F.struct(*rest.names)
            created = rows.select(
                F.lit(1).cast("long").alias(VERSION), *end.keys, F.lit(None).cast(rest).alias("_before"), made.alias("_after")
            )
            found = found.unionByName(created)
        return found

    def change_log(self, first: int, last: int) -> DataFrame:
        """Each version's changes as inserts, deletes and both images of updates, with their version."""
        return as_changes(self.change_rows(first, last), self.commit(last).keys, [VERSION])

    def changes_between(self, first: int, last: int) -> DataFrame:
        """What turns version ``first`` into ``last``, as a feed: changes that cancel out are left out.

        Reads change rows alone, one aggregation by key.
        """
        keys = self.commit(last).keys
        ends = self.change_rows(first, last).groupBy(*keys).agg(
            F.min_by("_before", VERSION).alias("_before"), F.max_by("_after", VERSION).alias("_after")
        )
        return as_changes(ends.where(~F.col("_before").eqNullSafe(F.col("_after"))), keys)

    def vacuum(self, keep: int) -> list[str]:
        """Forget all but the last ``keep`` versions and delete the folders no kept version names; returns these.

        Run it while no merge is under way: folders of an unpublished merge are deleted as well.
        """
        known = self.versions()
        old, kept = known[:-keep], [self.commit(v) for v in known[-keep:]]
        used = {f for c in kept for f in c.files.values()} | {c.changes for c in kept}
        for version in old:
            self.folder.delete(f"log/{version:012d}.json")
        unused = [f"{top}/{n}" for top in ("data", "changes") for n in self.folder.names(top) if f"{top}/{n}" not in used]
        for name in unused:
            self.folder.delete(name)
        return unused
