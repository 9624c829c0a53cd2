"""Star and forecast tables on storage."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reportstar.operators.quality import relationships
from reportstar.sources.publish import Files, place, publish

FORMATS = ("csv", "parquet")
# Delimited files as other programs take them: blanks stay, a quote is doubled, texts may hold line breaks.
# NULL is an empty cell and an empty text is "".
CSV_OPTIONS = {
    "header": "true",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "quote": '"',
    "escape": '"',
}
# Only an unquoted empty cell is NULL: the text that stands for it can't be in a file otherwise.
CSV_READ_OPTIONS = {"enforceSchema": "false", "multiLine": "true", "mode": "FAILFAST", "nullValue": "\x00"}

# Types of the star tables.
STAR_SCHEMAS = {
    "dim_cashier": "cashier_id bigint, cashier_name string",
    "dim_terminal": "terminal_id bigint, terminal_name string, terminal_type string",
    "dim_item": "item_id bigint, item_name string, category string",
    "dim_member": "member_id bigint, username string, firstname string, lastname string",
    "fact_cash_transactions": (
        "cashier_id bigint, transaction_datetime timestamp_ntz, income_expense string, "
        "payment_method string, transaction_type string, amount_tnd double, terminal_id bigint"
    ),
    "fact_sessions": (
        "cashier_id bigint, terminal_id bigint, session_type string, is_free_time boolean, "
        "paused_duration_minutes int, duration_minutes int, order_transfer_tnd double, "
        "usage_tnd double, discount_tnd double, total_amount_tnd double"
    ),
    "fact_stock_movements": (
        "cashier_id bigint, movement_datetime timestamp_ntz, item_id bigint, in_out string, "
        "quantity int, unit_price_tnd double, total_amount_tnd double, terminal_id bigint"
    ),
    "fact_member_stats": (
        "member_id bigint, duration_minutes int, usage_tnd double, "
        "orders_transfer_tnd double, total_amount_tnd double"
    ),
}
# What an analysis of consumption and revenue reads.
ANALYSIS_TABLES = {
    "cash": "fact_cash_transactions",
    "stock": "fact_stock_movements",
    "items": "dim_item",
}


def _check_format(fmt: str) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"Unknown fmt {fmt!r}; expected 'csv' or 'parquet'")


def _folder(name: str) -> str:
    return "dims" if name.startswith("dim_") else "facts"


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    _check_format(fmt)
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(path)


def write_all(tables: dict[str, DataFrame], output_dir: str, fmt: str = "csv") -> dict[str, int]:
    """Write ``dims/``, ``facts/`` and ``relationships.json``, replacing earlier output as a whole; returns the rows of each table.

    A run that fails leaves the earlier output as it was.
    """
    _check_format(fmt)
    spark = next(iter(tables.values())).sparkSession
    names = {f"{_folder(name)}/{name}": df for name, df in tables.items()}
    texts = {"relationships.json": relationships_text(tables)}
    rows = publish(spark, output_dir.rstrip("/\\"), names, lambda df, path: write_table(df, path, fmt), texts)
    return {name: rows[f"{_folder(name)}/{name}"] for name in tables}


def relationships_text(tables: dict[str, DataFrame]) -> str:
    """JSON of all relationships, one entry per foreign key column."""
    return json.dumps({"relationships": relationships(tables)}, indent=2)


def write_relationships(spark: SparkSession, tables: dict[str, DataFrame], path: str) -> None:
    """One JSON file with all relationships; written by the session's file system."""
    Files(spark).write(path, relationships_text(tables))


def read_table(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "csv") -> DataFrame:
    """Read a written table back with its types."""
    _check_format(fmt)
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS, **CSV_READ_OPTIONS)
    try:
        return reader.load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in (error.getCondition() or ""):
            raise FileNotFoundError(f"Run the pipeline first: {path} is missing") from error
        raise


def read_star(spark: SparkSession, output_dir: str, names=None, fmt: str = "csv") -> dict[str, DataFrame]:
    base = output_dir.rstrip("/\\")
    return {
        name: read_table(spark, place(spark, base, f"{_folder(name)}/{name}"), STAR_SCHEMAS[name], fmt)
        for name in names or STAR_SCHEMAS
    }


def load_data(spark: SparkSession, output_dir: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """``cash``, ``stock`` and ``items`` of an earlier run."""
    tables = read_star(spark, output_dir, ANALYSIS_TABLES.values(), fmt)
    return {short: tables[name] for short, name in ANALYSIS_TABLES.items()}
