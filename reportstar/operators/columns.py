"""Column rules used while exploring a report."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.functions.text import quoted


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without any value; one pass counts them all."""
    counts = df.agg(*[F.count(quoted(c)).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    return df.select(*[quoted(c) for i, c in enumerate(df.columns) if counts[f"c{i}"] > 0])


def drop_matching_columns(df: DataFrame, pattern: str = "Unnamed") -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if not re.search(pattern, c)])


def strip_column_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def keep_existing(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    return df.select(*[quoted(c) for c in wanted if c in df.columns])


def keep_raw(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_raw`` copies before the columns are cleaned."""
    return df.withColumns({f"{c}_raw": F.col(quoted(c)) for c in columns if c in df.columns})
