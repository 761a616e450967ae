"""A monitoring table and its profile, kept up to date from the files that a log has gained.

A refresh reads each file of the log once: the store keeps which files it has taken in. Records without a label yet wait in
the store and are asked again at the next refresh, with whatever labels there are then. New rows are compared with stored keys of
their own days only, and their counts (``profiles``) are added to those stored, so the profile never reads the log or the rows
again. All that a refresh writes is published as one version; a refresh that dies leaves the version before. A record that is
delivered again has the same time; a file that changes counts as new.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from larkspur.functions.columns import is_missing
from larkspur.operators.feature_table import latest_per_key
from larkspur.operators.joins import attach_label
from larkspur.operators.profiles import merged, observation_counts, profile_of
from larkspur.operators.versioned import Folder
from larkspur.workspace import materialize

DAY, COMMIT = "event_date", "_commit"
FILES = "path string, modificationTime timestamp, length long"


class QualityStore:
    """State in a folder. ``flatten`` turns log rows into scored records; ``numeric`` maps profiled columns to their types."""

    def __init__(
        self, spark: SparkSession, path: str, flatten: Callable[[DataFrame], DataFrame], row_key: Sequence[str], key: str,
        label: str, numeric: Mapping[str, str], time: str = "timestamp", model: str = "model_name", every: str = "30 minutes",
    ):
        self.spark, self.folder, self.flatten = spark, Folder(spark, path), flatten
        self.row_key, self.key, self.label, self.numeric = list(row_key), key, label, dict(numeric)
        self.time, self.model, self.every = time, model, every

    def state(self) -> dict:
        """What the last version names: its number, folders by kind, and how many files its refresh read."""
        known = [n for n in self.folder.names("log") if n.endswith(".json")]
        if not known:
            return {"version": 0, "rows": [], "keys": [], "counts": [], "files": [], "waiting": [], "files_read": 0}
        return json.loads(self.folder.read(f"log/{known[-1]}"))

    def _files(self) -> StructType:
        return self.spark.createDataFrame([], FILES).schema

    def _read(self, state: dict, kind: str, schema: StructType) -> DataFrame:
        paths = [f"{self.folder.path}/{name}" for name in state[kind]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", f"{self.folder.path}/{kind}")
        return reader.schema(StructType([*schema, StructField(COMMIT, StringType())])).parquet(*paths).drop(COMMIT)

    def _write(self, df: DataFrame, kind: str, by: Sequence[str] = ()) -> str:
        name = f"{kind}/{COMMIT}={uuid.uuid4().hex}"
        (df.hint("rebalance", *by) if by else df).write.partitionBy(*by).parquet(f"{self.folder.path}/{name}")
        return name

    def refresh(self, log: str, schema: StructType, labels: Sequence[DataFrame], files: str = "*.parquet") -> int:
        """Take in new files of the log folder, and waiting records that have a label now; returns the version."""
        state = self.state()
        known = self._read(state, "files", self._files())
        listed = self.spark.read.format("binaryFile").option("pathGlobFilter", files).load(log).select(known.columns)
        unseen = materialize(listed.join(known, known.columns, "left_anti"), "unseen")
        # The names of the files that came since the last refresh.
        paths = [r["path"] for r in unseen.select("path").collect()]
        read = self.spark.read.schema(schema)
        flat = self.flatten(read.parquet(*paths) if paths else self.spark.createDataFrame([], schema))
        kept = StructType([StructField(f.name, f.dataType) for f in flat.schema])
        records = latest_per_key(flat.unionByName(self._read(state, "waiting", kept)), self.row_key, [self.time])
        asked = attach_label(records, labels, self.key, self.label).withColumns(
            {"status": F.col("status").cast("double"), "prediction": F.col("prediction").cast("double")}
        )
        asked = asked.withColumn(DAY, F.coalesce(F.to_date(self.time).cast("string"), F.lit("none")))
        asked = materialize(asked.where(F.col("prediction").isNotNull() & ~is_missing(asked, "prediction")), "asked")
        unlabelled = F.col("status").isNull() | is_missing(asked, "status")

        days = [r[0] for r in asked.select(DAY).distinct().collect()]
        kinds = {f.name: f.dataType for f in asked.schema}
        key_schema = StructType([*[StructField(k, kinds[k]) for k in self.row_key], StructField(DAY, StringType())])
        held = self._read(state, "keys", key_schema).where(F.col(DAY).isin(days))
        new = materialize(asked.where(~unlabelled).join(held, [*self.row_key, DAY], "left_anti"), "new")
        counts = observation_counts(new, self.time, self.model, "status", "prediction", self.numeric, self.every)
        waiting = asked.where(unlabelled).join(held, [*self.row_key, DAY], "left_anti").select(*kept.names)
        after = {
            **state,
            "rows": [*state["rows"], self._write(new, "rows", [DAY])],
            "keys": [*state["keys"], self._write(new.select(*self.row_key, DAY), "keys", [DAY])],
            "counts": [*state["counts"], self._write(counts, "counts")],
            "files": [*state["files"], self._write(unseen, "files")],
            "waiting": [self._write(waiting, "waiting")],
            "files_read": len(paths),
            "row_schema": json.loads(new.schema.json()),
            "count_schema": json.loads(counts.schema.json()),
        }
        return self._publish(after)

    def _publish(self, state: dict) -> int:
        state = {**state, "version": state["version"] + 1}
        self.folder.publish(f"log/{state['version']:012d}.json", json.dumps(state))
        return state["version"]

    def rows(self) -> DataFrame:
        """The monitoring table: labelled records, each once."""
        state = self.state()
        return self._read(state, "rows", StructType.fromJson(state["row_schema"]))

    def waiting(self) -> int:
        """Records without a label."""
        state = self.state()
        names = state["waiting"]
        return self.spark.read.parquet(*[f"{self.folder.path}/{n}" for n in names]).count() if names else 0

    def counts(self) -> DataFrame:
        state = self.state()
        return merged(self._read(state, "counts", StructType.fromJson(state["count_schema"])))

    def profile(self) -> DataFrame:
        """The profile of all rows, from the stored counts."""
        return profile_of(materialize(self.counts(), "counts"), self.numeric)

    def compact(self) -> int:
        """The same state in one folder each for counts, keys and files."""
        state = self.state()
        keys = [f for f in StructType.fromJson(state["row_schema"]) if f.name in (*self.row_key, DAY)]
        return self._publish({
            **state,
            "counts": [self._write(self.counts(), "counts")],
            "keys": [self._write(self._read(state, "keys", StructType(keys)), "keys", [DAY])],
            "files": [self._write(self._read(state, "files", self._files()), "files")],
        })
