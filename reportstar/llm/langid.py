"""Language of texts: blended-spectrum kernels, Nystroem landmarks and kernel ridge regression.

A text is the set of its byte n-grams (n = 1 to 4, case folded, other signs as one blank), hashed to
``BITS`` places. The kernel of two texts is the size of the common set over the root of the product of
both sizes. Landmark texts map a kernel row to features in which one ridge regression per language
is solved; a batch is scored by two matrix products.

A null text, and one without any letter, gets ``und`` and score 0. Without learnable rows every text
gets ``und``. A null ``doc_id`` is never a learner and counts as not held out. Repeated rows teach once (of
texts under one ``doc_id`` the smallest) and are identified each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.llm.common import append_column, reach_workers, text_chunks

BITS = 1 << 14
NGRAMS = 4
#: Bounds of what is learnt from: texts and landmarks of each language.
PER_LANGUAGE = 600
PARTS = 256
LANDMARKS = 40
RIDGE = 1e-2
SHARPNESS = 6.0

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def fold(data: np.ndarray) -> np.ndarray:
    """Lower case for ASCII and for the Latin letters of two bytes that start with C3."""
    out = _FOLD[data]
    if len(data) > 1:
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][upper] += 0x20
    return out


def presence(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """0/1 matrix of the n-grams of each text of a chunk."""
    texts = len(bounds) - 1
    found = np.zeros(texts * BITS + 1, np.uint8)
    letters = fold(data).astype(np.uint32)
    base = np.repeat(np.arange(texts, dtype=np.int64) * BITS, np.diff(bounds))
    code = np.zeros(len(data), np.uint32)
    for n in range(1, NGRAMS + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        code = code[:size] * np.uint32(257) + letters[n - 1 :] + np.uint32(n)
        place = (code * np.uint32(2654435761)) >> np.uint32(32 - 14)
        at = base[:size] + place
        at[base[:size] != base[n - 1 :]] = texts * BITS  # runs over the end of its text
        found[at] = 1
    return found[:-1].reshape(texts, BITS)


def has_letter(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    ascii_letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    seen = np.concatenate([[0], np.cumsum(ascii_letter)])
    out = seen[bounds[1:]] > seen[bounds[:-1]]
    for i in np.flatnonzero(~out):
        out[i] = any(c.isalpha() for c in data[bounds[i] : bounds[i + 1]].tobytes().decode("utf-8", "ignore"))
    return out


@dataclass
class Kernel:
    """Landmarks, their sizes and, once solved, the weights per language."""

    marks: np.ndarray
    weights: np.ndarray | None = None
    languages: tuple[str, ...] = ()

    def rows(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        x = presence(data, bounds).astype(np.float32)
        size = np.sqrt(np.maximum(x.sum(1, keepdims=True), 1))
        own = np.sqrt(np.maximum(self.marks.sum(1, dtype=np.float32), 1))
        return x @ self.marks.T.astype(np.float32) / size / own


def solve(kernel: np.ndarray, own: np.ndarray, langs: np.ndarray, names: list[str]) -> np.ndarray:
    """Weights on raw kernel rows: whitening by the landmarks' own kernel, then ridge regression."""
    values, vectors = np.linalg.eigh(own)
    keep = values > 1e-6 * max(values.max(), 1e-12)
    white = vectors[:, keep] / np.sqrt(values[keep])
    x = np.hstack([kernel @ white, np.ones((len(kernel), 1))])
    y = np.where(langs[:, None] == np.array(names)[None, :], 1.0, -1.0)
    share = np.array([(langs == n).mean() for n in langs])
    x_w = x / share[:, None]  # each language weighs the same
    w = np.linalg.solve(x_w.T @ x + RIDGE * len(x) * np.eye(x.shape[1]), x_w.T @ y)
    return np.vstack([white @ w[:-1], w[-1:]])


def held_out(doc_id):
    """True where the language must not be learnt."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit_languages(docs: DataFrame) -> Kernel:
    """Learn from at most ``PER_LANGUAGE`` whole texts of each language, those of the smallest hashes.

    They are found on ids alone, with a rank that Spark bounds before the shuffle, and reach the
    driver as bit sets of ``BITS`` / 8 bytes and kernel rows, not as texts.
    """
    reach_workers(docs.sparkSession)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    ids = ids.select("doc_id", F.col("lang").cast("string").alias("lang")).distinct()
    # First within parts of a language, so that a frequent one is not ranked by one task.
    part = F.pmod(F.xxhash64(F.lit("part"), "doc_id"), F.lit(PARTS))
    first = F.row_number().over(Window.partitionBy("lang", part).orderBy(*order))
    ids = ids.withColumn("rank", first).filter(F.col("rank") <= PER_LANGUAGE)
    ids = ids.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ids = ids.filter(F.col("rank") <= PER_LANGUAGE)
    texts = docs.select(F.col("doc_id"), F.col("text")).filter(F.col("text").isNotNull())
    # One text per chosen id, however often it is repeated; reduced before the shuffle.
    chosen = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "lang", "rank").agg(F.min("text").alias("text"))
    chosen = chosen.select("text", "lang", "rank")
    schema = "bits binary, lang string, rank int"

    def sets(batches):
        for batch in batches:
            bits = [None] * batch.num_rows
            for first, data, bounds in text_chunks(batch.column(0), 1 << 18, 64):
                packed = np.packbits(presence(data, bounds), axis=1)
                for i in range(len(packed)):
                    bits[first + i] = packed[i].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array(bits, pa.binary()), batch.column(1), batch.column(2)], names=["bits", "lang", "rank"])

    got = sorted(((r.lang, r["rank"], bytes(r.bits)) for r in chosen.mapInArrow(sets, schema).collect()))
    if not got:
        return Kernel(np.zeros((0, BITS), np.uint8))
    langs = np.array([g[0] for g in got])
    packed = np.frombuffer(b"".join(g[2] for g in got), np.uint8).reshape(len(got), -1)
    names = sorted(set(langs))
    first = np.concatenate([np.flatnonzero(langs == n)[:LANDMARKS] for n in names])
    marks = np.unique(np.unpackbits(packed[first], axis=1), axis=0)
    size = np.sqrt(np.maximum(marks.sum(1, dtype=float), 1))
    z = marks.astype(np.float32)
    rows = []
    for at in range(0, len(packed), 256):
        x = np.unpackbits(packed[at : at + 256], axis=1).astype(np.float32)
        rows.append(x @ z.T / np.sqrt(np.maximum(x.sum(1, keepdims=True), 1)) / size)
    weights = solve(np.vstack(rows).astype(float), (z @ z.T / size[:, None] / size).astype(float), langs, names)
    return Kernel(marks, weights.astype(np.float32), tuple(str(n) for n in names))


def identify(docs: DataFrame, model: Kernel, name: str) -> DataFrame:
    """Add struct column ``name`` (``lang``, ``score``) to every row of ``docs``."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])

    def values(column):
        lang, score = np.full(len(column), "und", object), np.zeros(len(column))
        for first, data, bounds in text_chunks(column, 1 << 18, 64):
            known = np.flatnonzero(has_letter(data, bounds)) if model.languages else []
            if not len(known):
                continue
            margin = model.rows(data, bounds) @ model.weights[:-1] + model.weights[-1]
            grown = np.exp(SHARPNESS * (margin - margin.max(1, keepdims=True)).astype(float))
            best = margin.argmax(1)
            lang[first + known] = np.array(model.languages, object)[best[known]]
            score[first + known] = (1 / grown.sum(1))[known]
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score)], ["lang", "score"])

    return append_column(docs, "text", name, kind, values)
