"""Left outer joins onto tables with one row per key, safe for hot keys and large lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.functions.text import quoted, strip
from reportstar.staging import stage

# A lookup is broadcast only when it was measured to stay within both bounds.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Rows with a NULL key are spread over so many values that meet nothing.
SALTS = 1024

_KEY = "__lookup_key"
_SALT = "__lookup_salt"


def stage_measured(df: DataFrame, name: str) -> tuple[DataFrame, int, int]:
    """The stored table with its rows and bytes, which are counted while it is written."""
    width = F.lit(0)
    for field in df.schema.fields:
        text = isinstance(field.dataType, T.StringType)
        width = width + (F.coalesce(F.octet_length(quoted(field.name)), F.lit(0)) if text else 8)
    seen = Observation(f"size of {name}")
    sizes = F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")
    stored = stage(df.observe(seen, *sizes), name)
    return stored, seen.get["rows"], seen.get["bytes"]


def attach(
    left: DataFrame,
    lookup: DataFrame,
    left_key: str,
    lookup_key: str,
    null_safe: bool = False,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
    rows_at_most: int | None = None,
) -> DataFrame:
    """Add the other columns of ``lookup``; never multiplies or drops rows of ``left``.

    The lookup is stored once and measured there, unless the caller proves a bound with ``rows_at_most``. A
    small one is broadcast. A larger one is joined in one pass over ``left``: rows with a NULL key, which
    meet nothing, are spread by a salt, and since both sides are plain exchanges adaptive execution splits
    the partitions of frequent keys.
    """
    keyed = lookup.withColumnRenamed(lookup_key, _KEY)
    left_col = F.col(left_key)
    same = left_col.eqNullSafe(F.col(_KEY)) if null_safe else left_col == F.col(_KEY)
    if rows_at_most is not None and rows_at_most <= max_rows:
        return left.join(F.broadcast(keyed), same, "left").drop(_KEY)
    keyed, rows, size = stage_measured(keyed, "lookup")
    if rows <= max_rows and size <= max_bytes:
        return left.join(F.broadcast(keyed), same, "left").drop(_KEY)
    if null_safe:
        return left.join(keyed, same, "left").drop(_KEY)
    salt = F.when(left_col.isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(SALTS))).otherwise(F.lit(0))
    salted = left.withColumn(_SALT, salt)
    meets = same & (F.col(_SALT) == F.col(f"{_SALT}_right"))
    spread = keyed.withColumn(f"{_SALT}_right", F.lit(0).cast("bigint"))
    return salted.join(spread, meets, "left").drop(_KEY, _SALT, f"{_SALT}_right")


def resolve_fk(
    fact: DataFrame,
    source: str,
    dim: DataFrame,
    name_col: str,
    id_col: str,
    null_safe: bool = False,
    strip_keys: bool = False,
    **bounds: int,
) -> DataFrame:
    """Add ``id_col`` of the dimension row whose name equals ``source``; else NULL.

    Of several rows with one name the last, i.e. the largest id, is taken. ``null_safe``
    lets a NULL name match a NULL name. The name is compared as it stands;
    ``strip_keys`` trims it first, as the dimension does.
    """
    wanted = "__natural_key"
    lookup = dim.groupBy(name_col).agg(F.max(id_col).alias(id_col))
    key = strip(source) if strip_keys else F.col(source)
    return attach(
        fact.withColumn(wanted, key), lookup, wanted, name_col, null_safe, **bounds
    ).drop(wanted)


class Key(NamedTuple):
    """A foreign key to resolve: ``id_col`` of the row of ``dim`` whose ``name_col`` equals ``source``."""

    source: str
    dim: DataFrame
    name_col: str
    id_col: str
    null_safe: bool = False


def resolve_keys(
    fact: DataFrame, keys: Sequence[Key], strip_keys: bool = False, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """``resolve_fk`` for several keys. Lookups within the bounds are broadcast, all others are met in one pass.

    For those the fact is stored with row numbers. Its keys alone, as narrow rows of number, kind and text, are shuffled to the
    lookups, of which there is one table with kinds; equal keys of a frequent name can be split by adaptive execution, since both
    sides are plain exchanges. The ids of a row come together by its number and meet the fact in its only exchange.
    """
    large: list[tuple[Key, DataFrame]] = []
    for key in keys:
        lookup = key.dim.groupBy(key.name_col).agg(F.max(key.id_col).alias(key.id_col)).withColumnRenamed(key.name_col, _KEY)
        stored, rows, size = stage_measured(lookup, "lookup")
        if rows <= max_rows and size <= max_bytes:
            wanted = strip(key.source) if strip_keys else F.col(quoted(key.source))
            same = wanted.eqNullSafe(F.col(_KEY)) if key.null_safe else wanted == F.col(_KEY)
            fact = fact.join(F.broadcast(stored), same, "left").drop(_KEY)
        else:
            large.append((key, stored))
    if not large:
        return fact
    row, kind = "__fact_row", "__kind"
    stored_fact = stage(fact.withColumn(row, F.monotonically_increasing_id()), "fact")
    text = lambda k: (strip(k.source) if strip_keys else F.col(quoted(k.source))).cast("string")
    wanted = F.array(*[F.struct(F.lit(i).alias(kind), text(k).alias("__text"), F.lit(k.null_safe).alias("__safe")) for i, (k, _) in enumerate(large)])
    # A NULL that meets nothing needs no lookup.
    narrow = stored_fact.select(row, F.inline(wanted)).filter("__text is not null or __safe").drop("__safe")
    parts = [df.select(F.lit(i).alias("__of"), F.col(_KEY).cast("string").alias(_KEY), F.col(k.id_col).cast("bigint").alias("__id")) for i, (k, df) in enumerate(large)]
    known = stage(reduce(DataFrame.unionByName, parts), "lookups")
    met = narrow.join(known, (F.col(kind) == F.col("__of")) & F.col("__text").eqNullSafe(F.col(_KEY)))
    ids = met.groupBy(F.col(row).alias("__row")).agg(*[F.max(F.when(F.col(kind) == i, F.col("__id"))).alias(f"__id{i}") for i in range(len(large))])
    found = stored_fact.join(ids, F.col(row) == F.col("__row"), "left")
    made = [F.col(f"__id{i}").cast(k.dim.schema[k.id_col].dataType).alias(k.id_col) for i, (k, _) in enumerate(large)]
    return found.select(*[F.col(quoted(c)) for c in fact.columns], *made)
