"""Intermediate tables that several branches of a plan read: written once to the shared folder in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one of our own only where none is set and all tasks run in this machine's JVM (tests)."""
    if named := spark.conf.get("spark.checkpoint.dir", None):
        return named
    if not (own := spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(f"file://{tempfile.mkdtemp(prefix='basketry-')}")
        own = spark.sparkContext.getCheckpointDir()
    return own


def place(spark: SparkSession, name: str) -> str:
    """A folder's path that nothing else uses, in the shared folder. Removed when the driver ends."""
    path = f"{folder(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, written as Parquet and read again: computed once, its lineage ends there, and lost executors cost no recomputation. Removed when the driver ends, or by ``dropped``."""
    spark, path = df.sparkSession, place(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[id(out)] = (out, path)
    return out


#: Tables that are still there, by the frame that reads them.
_PATHS: dict[int, tuple[DataFrame, str]] = {}


def dropped(table: DataFrame) -> None:
    """Removes a table that ``written`` gave, once nothing will read it any more."""
    if found := _PATHS.pop(id(table), None):
        _remove(table.sparkSession, found[1])


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # noqa: BLE001  the session may be gone; the folder is scratch space
        return
