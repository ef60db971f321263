"""Session defaults and table access."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "lodestrata", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; keys in ``conf`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make the package importable in the session's Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="lodestrata-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    shutil.copytree(package, f"{folder}/src/{package.name}", ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", f"{folder}/src"))


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The Parquet table ``name`` under ``root``; timestamps without zone become plain timestamps."""
    ship(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")
