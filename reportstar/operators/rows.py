"""Row rules used while exploring a report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.functions.text import quoted

# Fixed value: a date inside a name shows report metadata.
DATE_IN_TEXT = "[0-9]{2}/[0-9]{2}/[0-9]{4}"


def drop_empty_rows(df: DataFrame) -> DataFrame:
    present = [F.col(quoted(c)).isNotNull() for c in df.columns]
    return df.filter(reduce(Column.__or__, present)) if present else df


def drop_incomplete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.filter(reduce(Column.__and__, [F.col(quoted(c)).isNotNull() for c in columns], F.lit(True)))


def drop_header_rows(df: DataFrame, column: str, header: str) -> DataFrame:
    """Drop rows that repeat the header; NULL rows stay."""
    return df.filter(~F.col(quoted(column)).eqNullSafe(F.lit(header)))


def drop_money_header_rows(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Drop rows in which every given column holds its own header text, in any case."""
    repeated = F.lit(True)
    for column, header in headers.items():
        repeated = repeated & F.lower(quoted(column)).contains(header.lower())
    return df.filter(~F.coalesce(repeated, F.lit(False)))


def drop_dated_names(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose name holds a date; NULL rows stay."""
    return df.filter(~F.coalesce(F.col(quoted(column)).rlike(DATE_IN_TEXT), F.lit(False)))


def keep_positive(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(quoted(column)) > 0)
