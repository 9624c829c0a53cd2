"""Profiles, totals, shares, histograms and previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.functions.numbers import money, money_sum
from reportstar.functions.text import quoted
from reportstar.functions.times import day
from reportstar.operators.quantiles import describe
from reportstar.operators.rows import drop_incomplete_rows

QUARTILES = (0.25, 0.5, 0.75)


def _known(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Groups with a NULL key do not count."""
    return drop_incomplete_rows(df, keys)


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(quoted(c)) for c in names]


def profile(df: DataFrame) -> DataFrame:
    """Name, type and non-null count of every column, in one pass."""
    counts = df.agg(*[F.count(c).alias(f"c{i}") for i, c in enumerate(_columns(df.columns))])
    rows = [
        F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"), F.col(f"c{i}").alias("non_null"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))


def summary(df: DataFrame) -> DataFrame:
    """Count, mean, std, min, quartiles and max of the numeric columns; quartiles are exact.

    The data are read once. A column without values has count 0 and NULLs, also in a table without rows.
    """
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    found = describe(df, numeric, QUARTILES)
    quartiles = [F.get("quantiles", F.lit(i)).alias(f"q{int(q * 100)}") for i, q in enumerate(QUARTILES)]
    return found.select("column", "count", "mean", "std", "min", *quartiles, "max")


def count_by(df: DataFrame, keys: Sequence[str], name: str = "n") -> DataFrame:
    return _known(df, keys).groupBy(*_columns(keys)).agg(F.count(F.lit(1)).alias(name))


def total_by(df: DataFrame, keys: Sequence[str], amount: str, name: str = "total") -> DataFrame:
    """Sum of an amount per key, exact to six decimals."""
    return _known(df, keys).groupBy(*_columns(keys)).agg(F.coalesce(money_sum(amount), F.lit(0.0)).alias(name))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str = "mean") -> DataFrame:
    return _known(df, keys).groupBy(*_columns(keys)).agg(F.avg(quoted(value)).alias(name))


def frequency(df: DataFrame, column: str) -> DataFrame:
    """Values and their counts, the most frequent first."""
    return count_by(df, [column]).orderBy(F.desc("n"), quoted(column))


def daily_total(df: DataFrame, stamp: str, amount: str, name: str = "total") -> DataFrame:
    return total_by(df.withColumn("day", day(stamp)), ["day"], amount, name)


def share_of_total(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Total per key and its share of the whole in percent, one decimal."""
    totals = _known(df, [key]).groupBy(quoted(key)).agg(F.sum(money(amount)).alias("__sum"))
    whole = totals.agg(F.sum("__sum")).scalar()
    return totals.select(
        quoted(key),
        F.col("__sum").cast("double").alias("total"),
        F.round(F.col("__sum").cast("double") / whole.cast("double") * 100, 1).alias("share_pct"),
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins ``bin, low, high, n``; the last one includes the maximum.

    Empty bins are listed. When all values are equal the width counts as one, as in
    ``[value - 0.5, value + 0.5]``.
    """
    values = df.select(F.col(quoted(column)).cast("double").alias("v")).filter("v is not null")
    ends = values.agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    low = ends.select(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo"))).scalar()
    high = ends.select(F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))).scalar()
    width = (high - low) / bins
    index = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).cast("int")
    counted = values.groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counted), "bin", "left").select(
        "bin",
        (low + width * F.col("bin")).alias("low"),
        (low + width * (F.col("bin") + 1)).alias("high"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
    )


def relation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Correlation and least-squares line of two measures."""
    return df.agg(
        F.corr(quoted(x), quoted(y)).alias("corr"),
        F.regr_slope(F.col(quoted(y)), F.col(quoted(x))).alias("slope"),
        F.regr_intercept(F.col(quoted(y)), F.col(quoted(x))).alias("intercept"),
    )


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 5) -> DataFrame:
    return df.orderBy(*[F.col(quoted(c)) if isinstance(c, str) else c for c in order]).limit(n)


def top(df: DataFrame, measure: str, ties: str, n: int = 10) -> DataFrame:
    """The ``n`` rows with the largest measure; equal ones by name."""
    return df.orderBy(F.desc(quoted(measure)), quoted(ties)).limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
