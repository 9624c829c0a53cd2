"""Exact quantiles and moments of numeric columns, without sorting or shuffling values.

A rank is selected by histograms. The first one counts values by sign and binary exponent and keeps the smallest and the
largest value of each class. The class that holds a wanted rank is divided into ``BUCKETS`` equal ranges and counted again, and so
on, until a range holds one distinct value, or so few rows that its values are counted themselves. A class spans a factor
of two, so doubles are told apart after five divisions at most. Each pass is a scan with counts that are reduced before
the shuffle: no task sees more than those counts, however many distinct values a range holds.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.functions.text import quoted
from reportstar.staging import stage

#: Ranges into which a part is divided, and rows up to which its values are counted themselves.
BUCKETS = 4096


class Part(NamedTuple):
    """Values of a column between two of them, and how many values of the column lie below."""

    column: str
    low: float
    high: float
    below: int
    rows: int


def stage_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as stored doubles ``c0, c1...``; NaN counts as no value."""
    values = [F.nanvl(F.col(quoted(c)).cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)]
    return stage(df.select(*values), "numbers")


def _signed_exponent(v: Column) -> Column:
    """Classes in the order of their values; an infinite value has a class of its own."""
    exponent = F.least(F.floor(F.least(F.log2(F.abs(v)), F.lit(1100.0))), F.lit(1100))
    return F.when(v == 0, 0.0).otherwise(F.signum(v) * (2000 + exponent))


def _counts(numbers: DataFrame, key: Column, columns: Sequence[str]) -> list:
    """``part, key, rows, low, high`` of all values ``v`` of ``columns`` whose ``key`` (a part and a class of it) isn't null.

    At most ``BUCKETS`` rows a part, or as many as there are exponents.
    """
    pairs = F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns]))
    found = numbers.select(pairs).filter("v is not null").select("v", key.alias("key")).filter("key is not null")
    return found.groupBy("key").agg(F.count(F.lit(1)).alias("rows"), F.min("v").alias("low"), F.max("v").alias("high")).collect()


def _first(numbers: DataFrame, columns: Sequence[str]) -> dict[str, list[Part]]:
    """Parts of each column by exponent, in order."""
    key = F.struct(F.col("column"), _signed_exponent(F.col("v")).alias("class"))
    rows = _counts(numbers, key, columns)
    return {c: _ordered(Part(c, -math.inf, math.inf, 0, 0), [r for r in rows if r["key"]["column"] == c]) for c in columns}


def _ordered(whole: Part, rows: list) -> list[Part]:
    parts, below = [], whole.below
    for r in sorted(rows, key=lambda r: r["key"]["class"]):
        parts.append(Part(whole.column, r["low"], r["high"], below, r["rows"]))
        below += r["rows"]
    return parts


def _divide(numbers: DataFrame, parts: Sequence[Part]) -> dict[Part, list[Part]]:
    """The parts of each part, in order. Parts don't overlap, so a value belongs to one at most."""
    v, key = F.col("v"), F.lit(None)
    for k, p in enumerate(parts):
        if p.rows <= BUCKETS:
            inner = v
        else:
            inner = F.least(F.floor((v - p.low) / (p.high - p.low) * BUCKETS), F.lit(BUCKETS - 1)).cast("double")
        mine = (F.col("column") == p.column) & (v >= p.low) & (v <= p.high)
        key = F.when(mine, F.struct(F.lit(k).alias("part"), inner.alias("class"))).otherwise(key)
    rows = _counts(numbers, key, sorted({p.column for p in parts}))
    return {p: _ordered(p, [r for r in rows if r["key"]["part"] == k]) for k, p in enumerate(parts)}


def _holding(parts: Sequence[Part], rank: int) -> Part:
    return next(p for p in parts if p.below <= rank < p.below + p.rows)


def select_ranks(numbers: DataFrame, wanted: dict[str, Sequence[float]]) -> dict[tuple[str, float], float]:
    """Linearly interpolated quantiles ``(column, share)`` of stored numbers; none for a column without values.

    The driver holds the counts of the parts in question: their number depends on columns and shares, not on rows.
    """
    first = _first(numbers, list(wanted)) if wanted else {}
    places, at = {}, {}
    for c, shares in wanted.items():
        total = sum(p.rows for p in first[c])
        for share in shares if total else ():
            place = share * (total - 1)
            places[c, share] = place
            for rank in (math.floor(place), math.ceil(place)):
                at[c, rank] = _holding(first[c], rank)
    while open_parts := sorted({p for p in at.values() if p.low < p.high}):
        divided = _divide(numbers, open_parts)
        at = {key: _holding(divided[p], key[1]) if p in divided else p for key, p in at.items()}
    out = {}
    for (c, share), place in places.items():
        low, high = at[c, math.floor(place)].low, at[c, math.ceil(place)].low
        out[c, share] = low + (high - low) * (place - math.floor(place)) if low < high else low
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``column, share, value`` of numeric columns."""
    found = select_ranks(stage_numbers(df, columns), {f"c{i}": list(shares) for i in range(len(columns))})
    rows = [(columns[int(c[1:])], share, value) for (c, share), value in found.items()]
    return df.sparkSession.createDataFrame(rows, "column string, share double, value double")


def describe(df: DataFrame, columns: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``column, count, mean, std, min, max`` and ``quantiles`` (an array in the order of ``shares``), a row per column.

    The input is read once; all figures come from the stored numbers.
    """
    names = [f"c{i}" for i in range(len(columns))]
    if not names:
        schema = "column string, count bigint, mean double, std double, min double, max double, quantiles array<double>"
        return df.sparkSession.createDataFrame([], schema)
    numbers = stage_numbers(df, columns)
    found = select_ranks(numbers, {c: list(shares) for c in names})
    # NULL in a column without values.
    quantiles = {c: F.array(*[F.lit(found.get((c, s))).cast("double") for s in shares]) for c in names}
    one = lambda c, name: F.struct(
        F.lit(name).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"), quantiles[c].alias("quantiles"))
    return numbers.agg(F.array(*[one(c, name) for c, name in zip(names, columns, strict=True)]).alias("all")).select(F.inline("all"))
