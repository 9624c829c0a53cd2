"""Tables that appear together or not at all.

A run writes its tables into a folder of its own inside the target. When all are there, one rename puts a journal next to it: from
then on the run counts, and readers take its tables from that folder. Then the tables are moved to their places and
folder and journal go. A run that fails before the rename leaves the old tables as they were; one that is cut off after
it is read as whole, and the next run finishes its moves first.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

JOURNAL = "_publish.json"


class Files:
    """The few operations on the session's file systems that publishing needs."""

    def __init__(self, spark: SparkSession):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.context = spark._jvm.org.apache.hadoop.fs.FileContext
        self.option = spark._jvm.org.apache.hadoop.fs.Options.Rename
        self.conf = spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway

    def _at(self, name: str):
        target = self.path(name)
        return target.getFileSystem(self.conf), target

    def exists(self, name: str) -> bool:
        files, target = self._at(name)
        return files.exists(target)

    def delete(self, name: str) -> None:
        files, target = self._at(name)
        files.delete(target, True)

    def read(self, name: str) -> str:
        files, target = self._at(name)
        stream = files.open(target)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        files, target = self._at(name)
        stream = files.create(target, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def rename(self, name: str, to: str) -> None:
        """One step of the file system, which replaces a file ``to``."""
        files, source = self._at(name)
        target = files.makeQualified(self.path(to))
        over = self.gateway.new_array(self.option, 1)
        over[0] = self.option.OVERWRITE
        self.context.getFileContext(target.toUri(), self.conf).rename(files.makeQualified(source), target, over)

    def move(self, name: str, to: str) -> None:
        """Put a folder or file in place of what is there."""
        self.delete(to)
        files, target = self._at(to)
        files.mkdirs(target.getParent())
        if not files.rename(self.path(name), target):
            raise OSError(f"Cannot move {name} to {to}")


def _journal(files: Files, base: str) -> dict | None:
    place = f"{base}/{JOURNAL}"
    return json.loads(files.read(place)) if files.exists(place) else None


def finish(spark: SparkSession, base: str) -> None:
    """Complete the moves of a published run, if there is one; may be repeated."""
    files = Files(spark)
    journal = _journal(files, base)
    if journal is None:
        return
    for name in journal["names"]:
        if files.exists(f"{base}/{journal['run']}/{name}"):
            files.move(f"{base}/{journal['run']}/{name}", f"{base}/{name}")
    files.delete(f"{base}/{JOURNAL}")
    files.delete(f"{base}/{journal['run']}")


def place(spark: SparkSession, base: str, name: str) -> str:
    """Where the published table or file ``name`` lies."""
    files = Files(spark)
    journal = _journal(files, base)
    if journal and name in journal["names"]:
        new = f"{base}/{journal['run']}/{name}"
        return new if files.exists(new) else f"{base}/{name}"
    return f"{base}/{name}"


def publish(
    spark: SparkSession, base: str, tables: dict[str, DataFrame], write: Callable[[DataFrame, str], None], texts: dict[str, str] | None = None
) -> dict[str, int]:
    """Write ``tables`` and small ``texts`` under ``base``, by their names in it; returns the rows of each table.

    Rows are counted while they are written.
    """
    finish(spark, base)
    files, run = Files(spark), f".run-{uuid.uuid4().hex}"
    rows = {}
    try:
        for name, df in tables.items():
            seen = Observation(f"rows of {name}")
            write(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{base}/{run}/{name}")
            rows[name] = seen.get["rows"]
        for name, text in (texts or {}).items():
            files.write(f"{base}/{run}/{name}", text)
        names = [*tables, *(texts or {})]
        files.write(f"{base}/{run}/journal", json.dumps({"run": run, "names": names}))
        files.rename(f"{base}/{run}/journal", f"{base}/{JOURNAL}")
    except BaseException:
        if not files.exists(f"{base}/{JOURNAL}"):
            files.delete(f"{base}/{run}")
        raise
    finish(spark, base)
    return rows
