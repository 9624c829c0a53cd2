"""Scans of plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_table(spark: SparkSession, path: str, deal_over: int | None = None) -> DataFrame:
    """A Parquet table as Spark splits it.

    ``deal_over`` deals the rows over so many tasks by a shuffle. It is for small tables of one row group,
    which a single task would parse alone; nothing is dealt unless it is asked for.
    """
    df = spark.read.parquet(path)
    return df.repartition(deal_over, df.columns[0]) if deal_over else df
