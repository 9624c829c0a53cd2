"""Staged report grids: ``report, source_file, row_idx, cells``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.functions.text import strip
from reportstar.operators.lookup import attach
from reportstar.sources.layouts import LAYOUTS

GRID_SCHEMA = T.StructType(
    [
        T.StructField("report", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("row_idx", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
    ]
)


def scan_grid(spark: SparkSession, path: str) -> DataFrame:
    """Grids staged as Parquet."""
    return spark.read.schema(GRID_SCHEMA).parquet(path)


def _pinned(spark: SparkSession) -> SparkSession:
    """A session with the settings of ``spark`` whose file scans are cut the same way every time.

    Else the splits depend on the number of cores at that moment, which grows and shrinks on a cluster.
    """
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            other.conf.set(key, value)
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        other.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)
    return other


def scan_text_grid(spark: SparkSession, path: str, report: str, sep: str = "\t") -> DataFrame:
    """Grids staged as delimited text, one grid row per line, one report per file.

    Large files are read in splits. A first pass counts the lines of each split and writes nothing but
    these counts; a line's number is its position in the split plus the lines of the splits before it. So no file has
    to pass through one task, and the numbers come with the scan: the text is not copied for them.

    The cells are made beside the position. Filters on cells can't be moved below that, where each of them would split the line again.
    """
    lines = _pinned(spark).read.option("recursiveFileLookup", "true").text(path).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.concat_ws("#", "_metadata.file_path", F.col("_metadata.file_block_start").cast("string")).alias("split"),
        F.split("value", sep).alias("cells"),
        F.monotonically_increasing_id().alias("seq"),
    )
    before = Window.partitionBy("source_file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        lines.groupBy("split", "source_file", "block")
        .agg(F.min("seq").alias("first_seq"), F.count(F.lit(1)).alias("n"))
        .select(
            F.col("split").alias("split_key"),
            (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_seq")).alias("shift"),
        )
    )
    changed = F.raise_error(F.lit("the files changed while they were read")).cast("bigint")
    return attach(lines, splits, "split", "split_key").select(
        F.lit(report).alias("report"),
        "source_file",
        (F.col("seq") + F.coalesce("shift", changed)).alias("row_idx"),
        "cells",
    )


def scan_reports(spark: SparkSession, input_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """One grid per known report, from ``<input_dir>/<report>``."""
    if fmt not in ("parquet", "text"):
        raise ValueError(f"Unknown fmt {fmt!r}; expected 'parquet' or 'text'")
    base = input_dir.rstrip("/\\")
    if fmt == "text":
        return {name: scan_text_grid(spark, f"{base}/{name}", name) for name in LAYOUTS}
    return {name: scan_grid(spark, f"{base}/{name}") for name in LAYOUTS}


def scan_with_header(grid: DataFrame, header_row: int = 4) -> DataFrame:
    """Columns named by the header row; the rows below it, blank cells as NULL.

    Unnamed and repeated columns are called ``Unnamed: i`` and ``name.1``, ``name.2``...
    All files of the grid must share one header.
    """
    headers = grid.filter(F.col("row_idx") == header_row).select("cells").distinct().take(2)
    if not headers:
        raise ValueError(f"no header row {header_row} in the grid")
    if len(headers) > 1:
        raise ValueError("files with different headers; scan them separately")
    cells = [c if c and c.strip() else f"Unnamed: {i}" for i, c in enumerate(headers[0]["cells"])]
    names: list[str] = []
    for name in cells:
        # The first number that neither an earlier column nor a header text has.
        tries = (name if not n else f"{name}.{n}" for n in range(len(cells) + 1))
        names.append(next(t for t in tries if t not in names and (t == name or t not in cells)))
    values = []
    for i, name in enumerate(names):
        cell = F.get("cells", F.lit(i))
        values.append(F.when(strip(cell) != "", cell).alias(name))
    return grid.filter(F.col("row_idx") > header_row).select(*values)
