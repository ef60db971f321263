"""Cutting lineage through a table in the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_own: dict[str, str] = {}
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; only a local session without it gets one of its own."""
    named = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="lodestrata-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return "file://" + _own[app]


def folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, which ``release``, and the end of the driver, delete with all that begins with it."""
    if not _written:
        atexit.register(_release_at_exit, spark)
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def cut(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: later stages restart from there.

    Used where several branches need one expensive result; an executor lost afterwards costs no recomputation.
    """
    spark = df.sparkSession
    path = folder(spark, "lodestrata")
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, since: int = 0) -> int:
    """Deletes what was written to the shared folder so far, or since ``mark`` gave that number; call it when the results
    that read it have been stored. Returns the number of paths."""
    jvm = spark.sparkContext._jvm
    n = len(_written) - since
    while len(_written) > since:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop() + "*")
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for found in fs.globStatus(path) or []:
            fs.delete(found.getPath(), True)
    return n


def _release_at_exit(spark: SparkSession) -> None:
    """Leaves nothing in the shared folder when the driver ends, if its session still runs."""
    try:
        if _written and not spark.sparkContext._jsc.sc().isStopped():
            release(spark)
    except Exception:  # noqa: BLE001, S110 - the session is gone, and with it the way to the files
        pass


def mark() -> int:
    """Where ``release`` is to stop: what is written before stays."""
    return len(_written)
