"""Removal of print artifacts from report grids, and the account of what was removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.functions.text import has_marker, strip
from reportstar.sources.layouts import (
    FIRST_DATA_ROW,
    PAGE_PATTERN,
    PAGE_TEXT,
    REPEATED_HEADER,
    Layout,
)


def is_preamble() -> Column:
    return F.col("row_idx") < FIRST_DATA_ROW


def is_page_marker() -> Column:
    """Any cell, mapped or not, holds ``Page x/y``.

    No match can span cells joined by a line break. The pattern is tried only on rows that
    pass the plain text test.
    """
    joined = F.array_join("cells", "\n")
    return F.coalesce(joined.contains(PAGE_TEXT) & joined.rlike(PAGE_PATTERN), F.lit(False))


def is_repeated_header(layout: Layout) -> Column:
    first = F.get("cells", F.lit(min(layout.columns)))
    return strip(first).eqNullSafe(F.lit(REPEATED_HEADER))


def is_keyless(layout: Layout) -> Column:
    index = next(i for i, name in layout.columns.items() if name == layout.key)
    return ~has_marker(F.get("cells", F.lit(index)))


def strip_artifacts(grid: DataFrame, layout: Layout, keep_position: bool = False) -> DataFrame:
    """Only the data rows, as named text columns.

    The rules are independent of one another, so the cheap ones are tested first and the
    search through all cells last. ``keep_position`` adds ``source_file, row_idx``.
    """
    position = ["source_file", "row_idx"] if keep_position else []
    return (
        grid.filter(~is_preamble())
        .filter(~is_keyless(layout))
        .filter(~is_repeated_header(layout))
        .filter(~is_page_marker())
        .select(
            *[F.get("cells", F.lit(i)).alias(name) for i, name in layout.columns.items()],
            *position,
        )
    )


def account(grid: DataFrame, layout: Layout) -> DataFrame:
    """Per file: rows in, rows dropped by each rule (the first that holds), rows kept, width."""
    rule = (
        F.when(is_preamble(), "preamble")
        .when(is_page_marker(), "page_marker")
        .when(is_repeated_header(layout), "repeated_header")
        .when(is_keyless(layout), "keyless")
        .otherwise("kept")
    )
    counts = [
        F.count_if(F.col("rule") == name).alias(name)
        for name in ("preamble", "page_marker", "repeated_header", "keyless", "kept")
    ]
    return (
        grid.select("report", "source_file", rule.alias("rule"), F.size("cells").alias("width"))
        .groupBy("report", "source_file")
        .agg(F.count(F.lit(1)).alias("rows_in"), *counts, F.max("width").alias("width"))
    )


def _narrow_files(grid: DataFrame, last: int) -> DataFrame:
    widths = grid.groupBy("source_file").agg(F.max(F.size("cells")).alias("width"))
    return widths.filter(F.col("width") <= last)


def check_width(grid: DataFrame, layout: Layout) -> None:
    """Raise ``KeyError`` when a file is too narrow for a mapped column.

    The preamble shows the width of a printed grid, and its few rows are all that is read,
    unless one of them is short: then the rows below decide.
    """
    last = max(layout.columns)
    if not _narrow_files(grid.filter(is_preamble()), last).take(1):
        return
    narrow = _narrow_files(grid, last).take(1)
    if narrow:
        raise KeyError(f"{narrow[0]['source_file']} has {narrow[0]['width']} columns, needs {last + 1}")
