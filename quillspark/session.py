"""Session helpers: a local session for tests and benches, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, memory: str = "16g", **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quillspark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="quillspark-")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one in spark.checkpoint.dir, or else the one given to setCheckpointDir. A session
    on one machine (master local) may do without and gets a temporary folder; anywhere else
    each executor would write to its own disk, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    folder = configured or context.getCheckpointDir()
    if folder:
        return folder
    if re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        return _own_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/quillspark/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: cut lineage that survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (what --py-files does on submit)."""
    context = spark.sparkContext
    if any("quillspark" in Path(f).name for f in context.listFiles):
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="quillspark-")) / "quillspark.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
