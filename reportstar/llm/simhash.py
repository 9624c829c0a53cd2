"""Near duplicates by SimHash fingerprints and pivot distance tables.

A fingerprint has bit j set where over half of the text's shingle hashes (XXH64, seed 42) have it.
Equal fingerprints fall together first. A table holds the Hamming distances of each distinct fingerprint
to fixed reference fingerprints, a byte each; by the triangle inequality two fingerprints within
``LIMIT`` bits differ by at most ``LIMIT`` in every coordinate. Alone, such a table must still be
compared row by row with every other. So pairs meet on four of six blocks of bits: ``LIMIT`` = 2 differing
bits leave at least four blocks equal. Then the largest coordinate difference discards pairs, and the
survivors are verified. Links make components.

Null and empty texts have fingerprint zero and are linked like any other. Repeated rows have equal
fingerprints. A null ``doc_id`` never is a component's id unless the component has no other.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.llm import near_copies
from reportstar.llm.common import append_column, components, free_name, staged, text_chunks, with_row_key

LIMIT = 2
WORDS = 3
SEED = 42
BLOCKS = (11, 11, 11, 11, 10, 10)
#: Reference fingerprints: eight to a table column, fixed by the seed.
PIVOTS = [int(x) for x in np.random.default_rng(64).integers(-(2**63), 2**63, 16)]

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def fingerprints(column: pa.Array) -> np.ndarray:
    """Fingerprint of each text as an unsigned number."""
    out = np.zeros(len(column), np.uint64)
    digest = xxhash.xxh64_intdigest
    for first, data, bounds in text_chunks(column):
        word = ~_BLANK[data]
        before = np.concatenate([[False], word[:-1]])
        before[bounds[:-1][bounds[:-1] < len(data)]] = False
        start = np.flatnonzero(word & ~before)
        if not len(start):
            continue
        after = np.concatenate([word[1:], [False]])
        inner = bounds[1:-1]
        after[inner[inner > 0] - 1] = False
        end = np.flatnonzero(word & ~after) + 1
        # One space after each word, so that a shingle is a slice.
        kept = word.copy()
        gap = end[end < len(data)]
        gap = gap[~word[gap]]
        kept[gap] = True
        lowered = _LOWER[data]
        lowered[gap] = 32
        place = np.cumsum(kept) - kept
        start, end = place[start], place[end - 1] + 1
        buffer = lowered[kept].tobytes()
        text = np.searchsorted(bounds, np.flatnonzero(word & ~before), "right") - 1
        count = np.bincount(text, minlength=len(bounds) - 1)
        some = np.flatnonzero(count)
        head = np.cumsum(count[some]) - count[some]
        shingles = np.maximum(count[some] - WORDS + 1, 1)
        at = np.cumsum(shingles) - shingles
        left = np.repeat(head - at, shingles) + np.arange(shingles.sum())
        right = np.minimum(left + WORDS - 1, np.repeat(head + count[some] - 1, shingles))
        hashes = np.fromiter(
            (digest(buffer[a:b], SEED) for a, b in zip(start[left].tolist(), end[right].tolist(), strict=True)),
            np.uint64, len(left),
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, at, axis=0, dtype=np.int64)
        over = np.packbits(2 * ones > shingles[:, None], axis=1, bitorder="little")
        out[first + some] = np.ascontiguousarray(over).view(np.uint64).ravel()
    return out


def masks() -> list[int]:
    """Signed 64-bit masks of four of the six blocks each."""
    ends = np.cumsum(BLOCKS)
    blocks = [((1 << n) - 1) << int(e - n) for n, e in zip(BLOCKS, ends, strict=True)]
    sums = [sum(four) for four in combinations(blocks, len(BLOCKS) - LIMIT)]
    return [m - (1 << 64) if m >> 63 else m for m in sums]


def pivot_table(prints: DataFrame) -> DataFrame:
    """Add ``t0, t1``: the distances of ``f`` to eight references each, a byte apiece."""
    for k in range(0, len(PIVOTS), 8):
        packed = F.lit(0).cast("long")
        for j, p in enumerate(PIVOTS[k : k + 8]):
            packed = packed.bitwiseOR(F.shiftleft(F.bit_count(F.col("f").bitwiseXOR(F.lit(p))).cast("long"), 8 * j))
        prints = prints.withColumn(f"t{k // 8}", packed)
    return prints


def largest_difference(x: str, y: str):
    """Largest difference of two packed rows of the pivot table."""
    parts = []
    for t in range(len(PIVOTS) // 8):
        for j in range(8):
            byte = lambda s, t=t, j=j: F.shiftrightunsigned(F.col(f"{s}.t{t}"), 8 * j).bitwiseAND(F.lit(255))
            parts.append(F.abs(byte(x) - byte(y)))
    return F.greatest(*parts)


def links(prints: DataFrame) -> DataFrame:
    """Pairs ``a < b`` of distinct fingerprints ``f`` within ``LIMIT`` bits."""
    table = pivot_table(prints)
    keys = F.explode(F.array(*(F.struct(F.lit(i).alias("m"), F.col("f").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(masks()))))
    parts = table.select("f", "t0", "t1", keys.alias("k")).select("f", "t0", "t1", "k.m", "k.key")
    x, y = parts.alias("x"), parts.alias("y")
    meet = (F.col("x.m") == F.col("y.m")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.f") < F.col("y.f"))
    near = largest_difference("x", "y") <= LIMIT
    exact = F.bit_count(F.col("x.f").bitwiseXOR(F.col("y.f"))) <= LIMIT
    return x.join(y, meet & near & exact).select(F.col("x.f").alias("a"), F.col("y.f").alias("b")).distinct()


def group_documents(docs: DataFrame, row: str) -> DataFrame:
    """``row, doc_id, f, component_id`` of every row; ``f`` is the fingerprint as a signed number."""
    hashed = append_column(docs.select(F.col(row).alias("row"), "doc_id", F.col("text").cast("string").alias("text")), "text", "f", T.LongType(), lambda c: pa.array(fingerprints(c).view(np.int64)))
    table = staged(hashed.select("row", "doc_id", "f"), "simhash")
    prints = staged(table.groupBy("f").agg(F.min("doc_id").alias("least")), "simhash_distinct")
    found = components(links(prints), "a", "b", "simhash_components")
    named = prints.join(found, F.col("f") == F.col("node"), "left").withColumn("c", F.coalesce("component", "f"))
    least = named.groupBy("c").agg(F.min("least").alias("component_id"))
    labels = staged(named.join(least, "c").select(F.col("f").alias("lf"), "component_id"), "simhash_labels")
    return table.join(labels, F.col("f") == F.col("lf")).drop("lf")


def keep_one(docs: DataFrame, words: int = WORDS, likeness: float | None = None) -> DataFrame:
    """One row of each group, the one with the smallest ``doc_id`` (of repeated rows the first).

    Groups are linked by ``LIMIT`` bits of the fingerprints over ``WORDS`` words; with a ``likeness``, by that share of common
    shingles of ``words`` words, which wider fingerprints find (``near_copies``).
    """
    if likeness is not None:
        return near_copies.keep_one(docs, words, likeness)
    row, kept = free_name(docs, "simhash_row"), free_name(docs, "simhash_kept")
    keyed = with_row_key(docs, row)
    table = group_documents(keyed, row).filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
    rows = table.groupBy("component_id").agg(F.min("row").alias(kept)).select(kept)
    return keyed.join(rows, F.col(row) == F.col(kept), "left_semi").drop(row)
