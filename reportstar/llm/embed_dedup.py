"""Near-duplicate vectors: randomised-rotation binary codes with stored correction factors.

Each distinct vector gets a code: the signs of its normalised, randomly rotated components, and a
correction factor, what the code shares with the vector it stands for. Dividing by it makes the product of a
code and another rotated vector an unbiased estimate of their inner product, with an error bound that
holds with high confidence (``EPSILON`` standard units). A pair whose upper bound is below the
threshold is dropped; every other pair is recomputed exactly, in double precision.

Pairs meet in tables on signs of further rotations. The signs of a table are ``BITS``, and more than the logarithm of the number of vectors, so that
unrelated vectors seldom meet; the tables are as many as it takes for two vectors at the threshold to share one with probability ``RECALL``. Each table is counted first, so that only
vectors with company fetch their components. A crowded bucket is dealt into blocks whose pairs of blocks are
compared one by one: nothing is capped. A pair counts in the first table where it meets.
Links leave a task as counts and as a spanning set of edges, never as pairs.

Vectors that are null, zero, empty or hold null or non-finite components link with nothing; vectors of different
length aren't compared. Equal vectors fall together first and count as each other's links. A null
``vec_id`` is never a component's id unless it has no other; its ``kept`` is false.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportstar.llm.common import components, reach_workers, staged

THRESHOLD = 0.9
#: Signs of a table at least, and how many more than the logarithm of the number of vectors.
BITS, SPARE_BITS = 20, 4
RECALL = 0.9475
EPSILON = 3.0
#: Vectors of a block of a crowded bucket.
BLOCK = 1024
_rotations: dict[tuple[int, int], np.ndarray] = {}


def plan_tables(count: int) -> tuple[int, int]:
    """Signs of a table and number of tables for so many vectors."""
    bits = max(BITS, math.ceil(math.log2(count + 1)) + SPARE_BITS)
    agree = 1 - math.acos(THRESHOLD) / math.pi
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - agree**bits))


def rotation(dim: int, more: int = 0) -> np.ndarray:
    """Random orthogonal matrices side by side, ``more`` columns after the first ``dim``."""
    if (dim, more) not in _rotations:
        rng = np.random.default_rng([17, dim])
        count = 1 + -(-more // dim)
        _rotations[dim, more] = np.hstack([np.linalg.qr(rng.normal(size=(dim, dim)))[0] for _ in range(count)])[:, : dim + more]
    return _rotations[dim, more]


def unit(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def table_keys(x: np.ndarray, bits: int, tables: int) -> np.ndarray:
    """Bucket of each vector in each table."""
    dim = x.shape[1]
    signs = (x @ rotation(dim, bits * tables)[:, dim:]) > 0
    return signs.reshape(len(x), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def code(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signs as -1 and 1, and the correction factor of each vector."""
    dim = x.shape[1]
    rotated = x @ rotation(dim)[:, :dim]
    return np.where(rotated > 0, 1, -1).astype(np.int8), np.abs(rotated).sum(1) / np.sqrt(dim)


def upper_bound(signs: np.ndarray, factor: np.ndarray, rotated: np.ndarray) -> np.ndarray:
    """Estimate plus error bound of the inner products of coded rows with rotated columns."""
    dim = signs.shape[1]
    estimate = (signs.astype(np.float32) @ rotated.T.astype(np.float32)) / np.sqrt(dim) / factor[:, None]
    error = EPSILON * np.sqrt(np.maximum(1 - factor**2, 0)) / factor / np.sqrt(max(dim - 1, 1))
    return estimate + error[:, None] + 1e-5


def _lengths(column: pa.Array) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for i, x in enumerate(column):
        out.setdefault(len(x), []).append(i)
    return out


def _index(batches, bits: int, tables: int):
    """Code and factor of each distinct vector, and its buckets."""
    for batch in batches:
        ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
        for dim, at in _lengths(vectors).items():
            x = unit([vectors[i] for i in at])
            keys, (signs, factor) = table_keys(x, bits, tables), code(x)
            packed = [r.tobytes() for r in np.packbits(signs > 0, axis=1)]
            names = ["u", "dim", "code", "factor", "buckets"]
            buckets = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, tables, dtype=np.int32), pa.array(keys.astype(np.int32 if bits < 32 else np.int64).ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(np.full(len(at), dim, np.int32)), pa.array(packed, pa.binary()), pa.array(factor), buckets], names=names)


def spanning(links: np.ndarray) -> np.ndarray:
    """Smallest position reachable by links, for a symmetric matrix of links."""
    label = np.arange(len(links))
    while True:
        least = np.minimum(label, np.where(links, label[None, :], len(links)).min(1))
        least = least[least]
        if (least == label).all():
            return label
        label = least


class Block:
    """Rows of some groups with their codes, exact vectors and buckets."""

    def __init__(self, table: pa.Table):
        get = lambda name: table.column(name).to_numpy()
        self.u, self.copies, self.factor, self.table = get("u"), get("copies"), get("factor"), get("t")
        self.side, self.cross = get("side"), get("bi") != get("bj")
        self.x = unit(table.column("embedding").to_pylist())
        dim = self.x.shape[1]
        packed = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(len(self.u), -1)
        self.signs = np.where(np.unpackbits(packed, axis=1)[:, :dim] > 0, 1, -1).astype(np.int8)
        self.rotated = self.x @ rotation(dim)[:, :dim]
        flat = table.column("buckets").combine_chunks()
        self.buckets = np.array(flat.flatten()).reshape(len(self.u), -1)

    def small(self, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Linked pairs of all groups of few rows, by the distance of two rows in their group."""
        last = np.repeat(start + size, size)
        rows = np.arange(len(last)) + np.repeat(start - (np.cumsum(size) - size), size)
        left, right = [], []
        for step in range(1, int(size.max(initial=1))):
            a = rows[rows + step < last]
            b = a + step
            ok = ~self.cross[a] | (self.side[a] != self.side[b])
            a, b = a[ok], b[ok]
            dim = self.signs.shape[1]
            estimate = np.einsum("ij,ij->i", self.signs[a], self.rotated[b]) / np.sqrt(dim) / self.factor[a]
            error = EPSILON * np.sqrt(np.maximum(1 - self.factor[a] ** 2, 0)) / self.factor[a] / np.sqrt(max(dim - 1, 1))
            near = estimate + error + 1e-5 >= THRESHOLD
            a, b = a[near], b[near]
            near = np.einsum("ij,ij->i", self.x[a], self.x[b]) >= THRESHOLD
            a, b = a[near], b[near]
            first = (self.buckets[a] == self.buckets[b]).argmax(1) == self.table[a]
            left.append(a[first])
            right.append(b[first])
        return np.concatenate([*left, np.zeros(0, int)]).astype(int), np.concatenate([*right, np.zeros(0, int)]).astype(int)

    def large(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Links of each row of one group, and the smallest row it is connected with."""
        s = slice(start, stop)
        near = upper_bound(self.signs[s], self.factor[s], self.rotated[s]) >= THRESHOLD
        near |= near.T
        np.fill_diagonal(near, False)
        if self.cross[start]:
            near &= self.side[s][:, None] != self.side[s][None, :]
        links = np.zeros_like(near)
        a, b = np.nonzero(near)
        for k in range(0, len(a), 1 << 18):
            i, j = a[k : k + (1 << 18)], b[k : k + (1 << 18)]
            links[i, j] = np.einsum("ij,ij->i", self.x[s][i], self.x[s][j]) >= THRESHOLD
        label = spanning(links)
        own = self.buckets[s]
        for t in range(int(self.table[start])):  # counted where they met before
            links &= own[:, t][:, None] != own[:, t][None, :]
        return links @ self.copies[s].astype(np.int64), label + start


_KEYS = ("t", "bucket", "bi", "bj")


def _compare(batches):
    """Counts of links and spanning edges of the groups of a sorted partition."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def groups(table: pa.Table):
        if not table.num_rows:
            return np.zeros(1, int)
        keys = np.stack([table.column(k).to_numpy() for k in _KEYS])
        return np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1, [table.num_rows]])

    def work(table: pa.Table):
        edges = groups(table)
        block = Block(table)
        size = np.diff(edges)
        few = size <= 32
        a, b = block.small(edges[:-1][few], size[few])
        u, v = [block.u[a], block.u[b]], [block.u[b], block.u[a]]
        n = [block.copies[b], block.copies[a]]
        for start, stop in zip(edges[:-1][~few].tolist(), edges[1:][~few].tolist(), strict=True):
            count, label = block.large(start, stop)
            u.append(block.u[start:stop])
            v.append(block.u[label])
            n.append(count)
        columns = [np.concatenate(x).astype(np.int64) for x in (u, v, n)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["u", "v", "n"])

    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= 8192:
            table = pa.Table.from_batches(held)
            # Whole groups only; vectors of one length at a time, as the key of a group holds it.
            cut = int(groups(table)[-2])
            if cut:
                for part in _by_length(table.slice(0, cut)):
                    yield work(part)
            table = table.slice(cut)
            held, rows = table.to_batches(), table.num_rows
    if rows:
        for part in _by_length(pa.Table.from_batches(held)):
            yield work(part)


def _by_length(table: pa.Table):
    dims = table.column("dim").to_numpy()
    for dim in np.unique(dims):
        yield table.filter(pa.array(dims == dim))


def group_vectors(vectors: DataFrame) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id``, ``embedding``)."""
    reach_workers(vectors.sparkSession)
    v = F.col("embedding").cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    good = F.coalesce(good, F.lit(False))
    rows = vectors.select("vec_id", v.alias("embedding"), good.alias("good"))
    named = rows.withColumn("h1", F.xxhash64("embedding")).withColumn("h2", F.xxhash64(F.lit(1), "embedding"))
    distinct = named.filter("good").groupBy("h1", "h2").agg(F.any_value("embedding").alias("embedding"), F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    distinct = staged(distinct, "vectors").withColumn("u", F.monotonically_increasing_id())
    bits, tables = plan_tables(distinct.count())
    kind = "int" if bits < 32 else "long"
    coded = distinct.select("u", "embedding").mapInArrow(lambda batches: _index(batches, bits, tables), f"u long, dim int, code binary, factor double, buckets array<{kind}>")
    index = staged(coded, "vector_codes")
    members = index.select("u", "dim", F.posexplode("buckets").alias("t", "bucket"))
    crowd = members.groupBy("dim", "t", "bucket").agg(F.count("*").alias("c")).filter("c > 1")
    met = members.join(crowd, ["dim", "t", "bucket"])
    blocks = F.ceil(F.col("c") / BLOCK).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("b", F.pmod(F.xxhash64("u"), F.col("blocks")).cast("int"))
    met = met.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("u", "t", "bucket", F.col("b").alias("side"), F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"))
    full = index.join(distinct.select("u", "embedding", "copies"), "u")
    groups = met.join(full, "u").repartition(F.col("dim"), *(F.col(k) for k in _KEYS)).sortWithinPartitions("dim", *_KEYS)
    found = staged(groups.mapInArrow(_compare, "u long, v long, n long"), "vector_links")
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    roots = components(found, "u", "v", "vector_components")
    result = distinct.select("u", "h1", "h2", "copies", "least").join(counts, "u", "left").join(roots, F.col("u") == F.col("node"), "left")
    result = result.withColumn("c", F.coalesce("component", "u"))
    least = result.groupBy("c").agg(F.min("least").alias("smallest"))
    result = result.join(least, "c").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "smallest")
    result = staged(result, "vector_groups")
    joined = named.select("vec_id", "good", "h1", "h2").join(result.withColumn("good", F.lit(True)), ["good", "h1", "h2"], "left")
    component = F.when(F.col("good"), F.col("smallest")).otherwise(F.col("vec_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
