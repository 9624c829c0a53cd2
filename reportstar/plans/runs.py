"""The two whole runs: reports to star schema, and star schema to forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reportstar.operators.clean import BAD, stage_all
from reportstar.operators.forecast import forecast_tables
from reportstar.operators.star import transform
from reportstar.operators.strip import check_width, strip_artifacts
from reportstar.sources.grid import scan_reports
from reportstar.sources.layouts import LAYOUTS
from reportstar.sources.publish import place, publish
from reportstar.sources.star import load_data, read_table, write_all, write_table
from reportstar.staging import run_folders


def ingest_all(
    spark: SparkSession, input_dir: str, fmt: str = "parquet", keep_position: bool = False
) -> dict[str, DataFrame]:
    """Text tables of the four reports staged under ``<input_dir>/<report>``."""
    raw = {}
    for name, grid in scan_reports(spark, input_dir, fmt).items():
        check_width(grid, LAYOUTS[name])
        raw[name] = strip_artifacts(grid, LAYOUTS[name], keep_position)
    return raw


def run_etl(
    spark: SparkSession,
    input_dir: str,
    output_dir: str,
    fmt: str = "csv",
    input_fmt: str = "parquet",
    strict: bool = True,
) -> DataFrame:
    """Build and write the star schema; returns the rows per written table, counted while they are written.

    Each report is read once: stripped, parsed and stored as typed columns with its bad cells, which are counted in that same
    pass and abort the run unless ``strict`` is off. Dimensions and facts read the stored columns that they need. The
    stored tables are removed at the end.
    """
    with run_folders(spark):
        parsed = stage_all(ingest_all(spark, input_dir, input_fmt), strict)
        cleaned = {name: df.drop(BAD) for name, df in parsed.items()}
        rows = write_all(transform(cleaned), output_dir, fmt)
    return spark.createDataFrame(list(rows.items()), "table string, rows bigint")


def run_forecast(
    spark: SparkSession,
    output_dir: str,
    forecast_dir: str,
    horizon: int = 30,
    freq: str = "D",
    fmt: str = "csv",
) -> dict[str, DataFrame]:
    """Forecast from a written star schema; writes and reads back ``consumption``, ``revenue`` and ``skipped``."""
    base = forecast_dir.rstrip("/\\")
    with run_folders(spark):
        data = load_data(spark, output_dir, fmt)
        tables = forecast_tables(data["cash"], data["stock"], data["items"], horizon, freq)
        made = {name: tables[name] for name in ("consumption", "revenue", "skipped")}
        publish(spark, base, {f"forecast_{name}": df for name, df in made.items()}, lambda df, path: write_table(df, path, fmt))
        return {name: read_table(spark, place(spark, base, f"forecast_{name}"), df.schema, fmt) for name, df in made.items()}
