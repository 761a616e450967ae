"""Where intermediate tables go.

A step that is used more than once, or whose numbering must not change when a task is retried, is written as Parquet
to the shared folder the cluster names in ``spark.checkpoint.dir`` and read back. That survives a lost executor, which
a cached or locally checkpointed DataFrame does not.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_created: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder; a temporary one only in local mode with nothing configured."""
    global _local_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/") + "/larkspur"
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="larkspur-")
    return _local_root


def new_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used before."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _created.append(path)
    return path


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` once and read it back: one pass over its inputs, no lineage behind it."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tasks a core when a table that is read many times is written; rows that are worth a task of their own when it is read.
_TASKS_A_CORE, _ROWS_A_TASK = 4, 10_000


def dealt(df: DataFrame) -> DataFrame:
    """``df`` in parts of equal size, some for each core: its own parts may be a few, as its files were written."""
    return df.repartition(_TASKS_A_CORE * df.sparkSession.sparkContext.defaultParallelism)


def tasks_for(df: DataFrame) -> int:
    """Tasks for short passes over a stored table: one for each core or, of many rows, several; fewer for few rows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    rows = df.count()
    if rows < cores * 100 * _ROWS_A_TASK:
        return min(cores, rows // _ROWS_A_TASK + 1)
    return df.rdd.getNumPartitions()


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables live in the shared folder."""
    path = new_path(spark, "db")
    name = "larkspur_" + path.rsplit("-", 1)[1][:12]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{path}'")
    return name


def release(spark: SparkSession) -> int:
    """Delete every folder this process made; call it once no DataFrame reads from them any more."""
    jvm = spark.sparkContext._jvm
    removed = 0
    while _created:
        path = jvm.org.apache.hadoop.fs.Path(_created.pop())
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        removed += int(fs.delete(path, True))
    return removed
