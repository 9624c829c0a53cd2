"""What the operators of this package share: row keys, text chunks, rolling hashes, components."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.staging import stage

CHUNK_BYTES = 1 << 20
HOME = str(Path(__file__).resolve().parents[2])
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def reach_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, if that folder is shared.

    On a cluster without such a folder the package is installed or sent along (``--py-files``) as usual.
    """
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if HOME not in paths:
        known["PYTHONPATH"] = os.pathsep.join([*paths, HOME])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, or ``base`` with underscores before it until no column has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = "_" + base
    return base


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` refers to it inside a lambda.

    A column of an earlier projection would be copied into the lambda when a filter is pushed below
    that projection, and then be computed for every element.
    """
    return F.get(F.transform(F.array(value), lambda v: use(v)), F.lit(0))


def with_row_key(docs: DataFrame, name: str) -> DataFrame:
    """Number the rows; ``docs`` must be a scan or a staged table, whose rows stay in place."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def staged(df: DataFrame, name: str) -> DataFrame:
    """``stage`` that lets Spark remove the shuffle files of the written plan at its end."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        return stage(df, name)
    finally:
        conf.set(key, before)


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES, rows: int = 1 << 30):
    """Yield ``(first row, bytes, row bounds)`` of whole texts; NULL is an empty text.

    A chunk holds at most ``limit`` bytes and ``rows`` texts, or one text that is longer.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    column = column.cast(pa.large_binary())
    _, ends, values = column.buffers()
    bounds = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), first + rows, len(column))
        yield first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def _table(base: int, n: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(n, 1 << 16)
        size = 1 << (size - 1).bit_length()
        known = np.full(size, base, np.uint64)
        known[0] = 1
        known = _powers[base] = np.multiply.accumulate(known)
    return known[:n]


class RollingHash:
    """Hash of any slice of ``data`` from prefix sums of a polynomial modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _table(_BASE, n), out=self.sums[1:])
        self.back = _table(_INVERSE, n + 1)

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start])

    def grams(self, n: int) -> np.ndarray:
        """Hashes of all slices of ``n`` bytes, by their start."""
        return mix((self.sums[n:] - self.sums[:-n]) * self.back[: len(self.sums) - n])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def append_column(docs: DataFrame, text: str, name: str, kind: T.DataType, values: Callable) -> DataFrame:
    """Add column ``name``: ``values(text array)`` returns an Arrow array for each batch."""
    reach_workers(docs.sparkSession)
    schema = T.StructType(docs.schema.fields + [T.StructField(name, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, values(batch.column(at))], names=[*batch.schema.names, name]
            )

    return docs.mapInArrow(run, schema)


def components(edges: DataFrame, a: str, b: str, name: str = "components") -> DataFrame:
    """Smallest label reachable from each node, where that is not the node itself: ``(node, component)``.

    Alternates the large-star and the small-star step, each one grouping by a minimum and one
    join, until the edges stay as they are. Both steps keep the number of edges; a node with many
    edges is reduced before the shuffle, and its join is one that adaptive execution can split.
    """
    edges = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct()
    edges = staged(edges, name)
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = staged(small, name)
        sign = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if tuple(sign) == before:
            break
        before = tuple(sign)
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
