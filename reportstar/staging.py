"""Intermediate tables that are written once to the shared folder and read back.

A staged table cuts the lineage, outlives a lost executor and gives every later plan the
same rows, also where their order decides (ordinals, line numbers).
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}
# Folders made by the run that this thread is in.
_run: ContextVar[list[str] | None] = ContextVar("run", default=None)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary folder only in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        _local[app] = tempfile.mkdtemp(prefix="reportstar-")
    return _local[app]


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_folder(spark)}/reportstar/{name}-{uuid.uuid4().hex}"
    made = _run.get()
    if made is not None:
        made.append(path)
    return path


@contextmanager
def run_folders(spark: SparkSession):
    """Remove, at the end, every folder of intermediate tables made inside; yields their list.

    Runs in other threads, and a run around this one, keep theirs.
    """
    made: list[str] = []
    token = _run.set(made)
    try:
        yield made
    finally:
        _run.reset(token)
        for path in made:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
