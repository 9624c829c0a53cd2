"""Quality of texts: random-indexing word vectors, pooled, then a small network.

A word falls into one of ``SLOTS`` slots by its hash. A slot has a sparse random index vector; its
context vector is the sum of the index vectors of its neighbours over the whole corpus, reduced in
one grouping. A text is the mean and the spread of its words' vectors and how alike neighbours are.
The network has one hidden layer and is trained on a bounded sample of the labelled rows; a
temperature fitted on rows apart from these calibrates its probabilities.

Null and empty texts have no words: their features are zero and their score is what the network
gives for that. Null labels and labels without a document teach nothing; repeated rows teach once (of texts
under one ``doc_id`` the smallest) and are scored each.
With no label, or labels of one kind, the score is the share of label 1 (0.5 without labels).
A null ``doc_id`` is never a learner and counts as not held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.llm.common import RollingHash, append_column, free_name, reach_workers, text_chunks

SLOTS = 8192
DIMS = 32
NONZERO = 4
#: Bound of the sample of labelled rows that the network learns from.
SAMPLE = 12_000
HIDDEN = 32
EPOCHS = 40

_rng = np.random.default_rng(7)
_PLACES = np.argsort(_rng.random((SLOTS, DIMS)), axis=1)[:, :NONZERO].astype(np.int64)
_SIGNS = _rng.choice(np.array([-1.0, 1.0]), (SLOTS, NONZERO))
INDEX = np.zeros((SLOTS, DIMS))
np.put_along_axis(INDEX, _PLACES, _SIGNS, axis=1)

# Classes of bytes: 0 blank, 1 letter or part of a longer character, 2 digit, 3 sign.
_KIND = np.full(256, 3, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KIND[48:58] = 2


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot and row of every word: runs of letters, of digits or of signs."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    new = np.empty(len(data), bool)
    new[0] = True
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[bounds[:-1][bounds[:-1] < len(data)]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(data))
    kept = kind[start] > 0
    start, end = start[kept], end[kept]
    slot = (RollingHash(data).slices(start, end) % np.uint64(SLOTS)).astype(np.int64)
    return slot, np.searchsorted(bounds, start, "right") - 1


def context_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Context vector of every slot over all texts; ``SLOTS`` rows reach the driver, whatever the input."""
    reach_workers(docs.sparkSession)
    fields = [T.StructField("slot", T.IntegerType())]
    fields += [T.StructField(f"d{i}", T.LongType()) for i in range(DIMS)]

    def count(batches):
        total = np.zeros(SLOTS * DIMS)
        for batch in batches:
            for _, data, bounds in text_chunks(batch.column(0)):
                slot, row = words(data, bounds)
                same = row[1:] == row[:-1]
                left, right = slot[:-1][same], slot[1:][same]
                for a, b in ((left, right), (right, left)):
                    for j in range(NONZERO):
                        total += np.bincount(a * DIMS + _PLACES[b, j], _SIGNS[b, j], SLOTS * DIMS)
        table = total.reshape(SLOTS, DIMS).astype(np.int64)
        used = np.flatnonzero(table.any(axis=1))
        columns = [pa.array(used.astype(np.int32)), *(pa.array(table[used, i]) for i in range(DIMS))]
        yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    sums = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, T.StructType(fields))
    found = sums.groupBy("slot").agg(*(F.sum(f"d{i}").alias(f"d{i}") for i in range(DIMS))).toPandas()
    table = np.zeros((SLOTS, DIMS))
    table[found["slot"].to_numpy(int)] = found.drop(columns="slot").to_numpy(float)
    norm = np.linalg.norm(table, axis=1, keepdims=True)
    return table / np.where(norm > 0, norm, 1)


def features(column: pa.Array, context: np.ndarray) -> np.ndarray:
    """Pooled vectors of each text: means, spread, likeness of neighbours and length."""
    out = np.zeros((len(column), 4 * DIMS + 4))
    both = np.hstack([context, INDEX / np.sqrt(NONZERO)])
    for first, data, bounds in text_chunks(column, 1 << 18):
        slot, row = words(data, bounds)
        if not len(slot):
            continue
        count = np.bincount(row, minlength=len(bounds) - 1)
        some = np.flatnonzero(count)
        at = np.cumsum(count[some]) - count[some]
        n = count[some, None]
        vectors = both[slot]
        mean = np.add.reduceat(vectors, at) / n
        spread = np.sqrt(np.maximum(np.add.reduceat(vectors**2, at) / n - mean**2, 0))
        alike = np.zeros((len(slot), 2))
        for lag in (1, 2):
            alike[lag:, lag - 1] = (slot[lag:] == slot[:-lag]) & (row[lag:] == row[:-lag])
        alike = np.add.reduceat(alike, at) / n
        norm = np.linalg.norm(mean[:, DIMS:], axis=1, keepdims=True)
        out[first + some] = np.hstack([mean, spread, alike, norm, np.log1p(n) / 10])
    return out


@dataclass
class Network:
    """Two layers over standardised features; ``temperature`` divides the logit."""

    shift: np.ndarray
    scale: np.ndarray
    layers: list
    temperature: float = 1.0
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.shift) / self.scale @ w1 + b1) @ w2 + b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 1) -> Network:
    """Adam on four fifths of the rows; the temperature from the rest."""
    width = x.shape[1] if x.ndim == 2 else 1
    if not len(y) or y.min() == y.max():
        return Network(np.zeros(width), np.ones(width), [], constant=float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    apart = order[: len(y) // 5]
    learn = order[len(y) // 5 :]
    shift, scale = x[learn].mean(0), x[learn].std(0) + 1e-3
    layers = [rng.normal(0, width**-0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    net = Network(shift, scale, layers)
    z = (x - shift) / scale
    m, v, t = [0.0] * 4, [0.0] * 4, 0
    for epoch in range(EPOCHS):
        rate = 0.01 * 0.5 * (1 + np.cos(np.pi * epoch / EPOCHS))
        for rows in np.array_split(rng.permutation(learn), max(1, len(learn) // 64)):
            h = np.tanh(z[rows] @ layers[0] + layers[1])
            p = 1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -40, 40)))
            d = (p - y[rows]) / len(rows)
            back = np.outer(d, layers[2]) * (1 - h**2)
            grads = [z[rows].T @ back + 1e-4 * layers[0], back.sum(0), h.T @ d + 1e-4 * layers[2], d.sum(keepdims=True)]
            t += 1
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g**2
                layers[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    if len(apart) >= 20:
        logit, truth = net.logits(x[apart]), y[apart]
        loss = lambda k: np.logaddexp(0, np.where(truth > 0.5, -1, 1) * logit / k).mean()
        net.temperature = float(min(np.geomspace(0.5, 8, 41), key=loss))
    return net


def held_out(doc_id):
    """True where the label must not be learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors of all of ``docs`` and a network from at most ``sample`` labelled rows.

    The rows with the smallest hashes are taken, a bounded sort on ids alone; their texts are met
    by a broadcast of at most ``sample`` ids.
    """
    context = context_vectors(docs)
    chosen = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = chosen.select("doc_id", F.col("quality").cast("double").alias("quality"))
    chosen = chosen.distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample)
    # One text per label, however often a doc_id is repeated; reduced before the shuffle.
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = rows.groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("text", "quality")
    schema = T.StructType([T.StructField("x", T.BinaryType()), T.StructField("y", T.DoubleType())])

    def pooled(batches):
        for batch in batches:
            x = features(batch.column(0), context).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), batch.column(1)], names=["x", "y"])

    got = sorted((bytes(r.x), r.y) for r in rows.mapInArrow(pooled, schema).collect())
    x = np.array([np.frombuffer(r, np.float32) for r, _ in got], float).reshape(len(got), 4 * DIMS + 4)
    return context, train(x, np.array([y for _, y in got]))


def score_quality(docs: DataFrame, model: tuple[np.ndarray, Network], name: str) -> DataFrame:
    """Add column ``name``, the probability of label 1, to every row of ``docs``."""
    context, net = model

    def values(column):
        return pa.array(net.probability(features(column, context).astype(np.float32).astype(float)), pa.float64())

    return append_column(docs, "text", name, T.DoubleType(), values)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Rows whose score reaches ``threshold``, with the columns of ``docs`` as they were."""
    name = free_name(docs, "quality_score")
    return score_quality(docs, fit_quality(docs, labels), name).filter(F.col(name) >= threshold).drop(name)
