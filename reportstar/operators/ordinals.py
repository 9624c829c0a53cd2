"""Global positions without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.staging import stage

_POS = "__pos"
_PART = "__part"
# monotonically_increasing_id keeps the partition above, the row position below this bit.
_ROW_BITS = 33


def _ranged(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Range-partitioned, sorted and staged, with the position of each row."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_POS, F.monotonically_increasing_id())
    )
    return stage(placed, name).withColumn(_PART, F.shiftright(_POS, _ROW_BITS))


def with_ordinal(df: DataFrame, id_col: str, order: Sequence[Column]) -> DataFrame:
    """Number the rows 1..n in ``order`` and put the number first.

    Each range of keys is sorted by its own task. The numbers of a range start after the
    rows of the ranges before it; that table has one row per range, i.e. per task that
    wrote, hence the driver adds it up and it is broadcast.
    """
    placed = _ranged(df, order, id_col)
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias("n")).orderBy(_PART).collect()
    starts = accumulate((r["n"] for r in sizes), initial=0)
    offsets = df.sparkSession.createDataFrame(
        [(r[_PART], start) for r, start in zip(sizes, starts)], f"{_PART} bigint, __offset bigint"
    )
    row = F.col(_POS).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), _PART).select(
        (F.col("__offset") + row + 1).alias(id_col), *df.columns
    )
