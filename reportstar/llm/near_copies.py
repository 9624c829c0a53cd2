"""Near copies by wide SimHash fingerprints: one document of each group of similar texts stays.

Texts are similar if the sets of their ``words``-word shingles have a Jaccard likeness of at least ``likeness``.

* A text gets a SimHash fingerprint of ``BITS`` bits over its shingles; equal texts (as words) fall together first. At a likeness of
  0.8 two fingerprints agree in a bit with probability 0.849.
* Tables of sampled bits: in each of them a fingerprint is filed under some of its bits. The bits are as many as the logarithm of the number of texts,
  so that unrelated texts seldom meet, and the tables as many as it takes for similar texts to meet with probability ``RECALL`` at least.
  Both follow from the number of texts; no file is cut.
* What meets is discarded by the distance table: by the triangle inequality, distances to reference fingerprints differ by no more than the
  distance of the two. Then bits are counted: beyond ``RADIUS`` differing bits (four standard deviations above the mean at 0.8) texts are not similar.
* Survivors are verified by their shingles, exactly.

A file of many near copies is not compared pair by pair. First each text meets only the first of its file; what is verified makes components.
Then texts of one file meet across components only, and of its largest component each meets those outside it. So a group of copies,
however large, costs a comparison or two per copy and table, and no link between two components is passed over.

Null and empty texts are equal texts without shingles, similar to each other only. Texts of fewer words than a shingle have one, the whole. Very long
texts are taken whole. Repeated rows are copies. Of a group the row with the smallest ``doc_id`` stays (nulls last), of these
the first in the order of the stored rows; all columns pass through. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.llm.common import RollingHash, components, free_name, mix, reach_workers, staged, text_chunks, with_row_key

WORDS, LIKENESS = 5, 0.8
BITS = 256
#: Probability with which two texts at the likeness meet in a table at least.
RECALL = 0.97
#: Reference fingerprints of the distance table.
PIVOTS = 4

_LANES = BITS // 64
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SALTS = [np.uint64(x) for x in np.random.default_rng(5).integers(1, 2**63, _LANES + 1)]


def agreement(likeness: float) -> float:
    """Probability that a bit of two fingerprints agrees, for texts of one size."""
    cosine = 2 * likeness / (1 + likeness)
    return 1 - math.acos(min(cosine, 1.0)) / math.pi


def radius(likeness: float) -> int:
    off = 1 - agreement(likeness)
    return math.ceil(BITS * off + 4 * math.sqrt(BITS * off * (1 - off)))


def plan_tables(count: int, likeness: float) -> tuple[int, int]:
    """Sampled bits of a table and number of tables for so many texts."""
    bits = max(14, math.ceil(math.log2(count + 1)))
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - agreement(likeness) ** bits))


def word_texts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased words with one space between, bounds of words, and the text of each word."""
    word = ~_BLANK[data]
    before = np.concatenate([[False], word[:-1]])
    before[bounds[:-1][bounds[:-1] < len(data)]] = False
    start = np.flatnonzero(word & ~before)
    after = np.concatenate([word[1:], [False]])
    inner = bounds[1:-1]
    after[inner[inner > 0] - 1] = False
    end = np.flatnonzero(word & ~after) + 1
    text = np.searchsorted(bounds, start, "right") - 1
    size = end - start
    # Each word and a space behind it.
    at = np.concatenate([[0], np.cumsum(size + 1)])
    out = np.full(at[-1], 32, np.uint8)
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(at[:-1], size) + place] = _LOWER[data[np.repeat(start, size) + place]]
    return out, at[:-1], at[:-1] + size, text


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle, repeats included, and the text it is of."""
    out, start, end, text = word_texts(data, bounds)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = np.bincount(text, minlength=len(bounds) - 1)
    some = np.flatnonzero(count)
    head = np.cumsum(count[some]) - count[some]
    each = np.maximum(count[some] - words + 1, 1)
    at = np.cumsum(each) - each
    left = np.repeat(head - at, each) + np.arange(each.sum())
    right = np.minimum(left + words - 1, np.repeat(head + count[some] - 1, each))
    return RollingHash(out).slices(start[left], end[right]), np.repeat(some, each)


def fingerprints(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """``BITS`` bits of each text as unsigned lanes, and two names of its words."""
    prints, names = np.zeros((len(column), _LANES), np.uint64), np.zeros((len(column), 2), np.uint64)
    for first, data, bounds in text_chunks(column):
        out, start, end, text = word_texts(data, bounds)
        if not len(start):
            continue
        # Words in order: sums over word hashes times powers of two odd numbers.
        hashes = RollingHash(out).slices(start, end)
        begin = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        order = np.arange(len(start)) - np.repeat(begin, np.diff(np.append(begin, len(start))))
        for k in range(2):
            placed = mix(mix(hashes ^ _SALTS[k]) + mix(order.astype(np.uint64) + _SALTS[k + 2]))
            names[first + text[begin], k] = np.add.reduceat(placed, begin)
        shingles, owner = shingle_hashes(data, bounds, words)
        begin = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        total = np.diff(np.append(begin, len(owner)))
        for lane in range(_LANES):
            salted = mix(shingles ^ _SALTS[lane])
            bits = np.unpackbits(salted.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones = np.add.reduceat(bits, begin, axis=0, dtype=np.int32)
            over = np.packbits(2 * ones > total[:, None], axis=1, bitorder="little")
            prints[first + owner[begin], lane] = np.ascontiguousarray(over).view(np.uint64).ravel()
    return prints, names


def print_table(docs: DataFrame, row: str, words: int) -> DataFrame:
    """``row, doc_id, k0, k1, f0...`` of every row."""
    lanes = [f"f{i}" for i in range(_LANES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, names = fingerprints(batch.column(2), words)
            numbers = [*names.view(np.int64).T, *prints.view(np.int64).T]
            columns = [batch.column(0), batch.column(1), *(pa.array(np.ascontiguousarray(x)) for x in numbers)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "k0", "k1", *lanes])

    reach_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    narrow = docs.select(F.col(row).alias("row"), "doc_id", F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, f"row long, doc_id {kind}, k0 long, k1 long, " + ", ".join(f"{c} long" for c in lanes))


def _lanes(side: str = "") -> list[Column]:
    return [F.col(f"{side}f{i}") for i in range(_LANES)]


def _sampled(bits: int, tables: int) -> list[list[int]]:
    """Masks of each table, a lane apiece, as signed numbers."""
    rng, out = np.random.default_rng(256), []
    for _ in range(tables):
        mask = [0] * _LANES
        for b in rng.choice(BITS, bits, replace=False):
            mask[b // 64] |= 1 << int(b % 64)
        out.append([m - (1 << 64) if m >> 63 else m for m in mask])
    return out


def file_entries(prints: DataFrame, bits: int, tables: int) -> DataFrame:
    """``file, id, f0...``: each text under its sampled bits, once per table."""
    keys = [F.xxhash64(F.lit(t), *(lane.bitwiseAND(F.lit(m)) for lane, m in zip(_lanes(), mask, strict=True))) for t, mask in enumerate(_sampled(bits, tables))]
    return prints.select(F.explode(F.array(*keys)).alias("file"), *[c for c in prints.columns])


def _pivot_distances(side: str) -> list[Column]:
    rng = np.random.default_rng(64)
    return [
        sum((F.bit_count(lane.bitwiseXOR(F.lit(int(p)))) for lane, p in zip(_lanes(side), rng.integers(-(2**63), 2**63, _LANES), strict=True)), F.lit(0))
        for _ in range(PIVOTS)
    ]


def _within(x: str, y: str, limit: int) -> Column:
    """Pivot distances and bits of two fingerprints differ by ``limit`` at most."""
    near = F.lit(True)
    for a, b in zip(_pivot_distances(x), _pivot_distances(y), strict=True):
        near = near & (F.abs(a - b) <= limit)
    apart = sum((F.bit_count(a.bitwiseXOR(b)) for a, b in zip(_lanes(x), _lanes(y), strict=True)), F.lit(0))
    return near & (apart <= limit)


def _sided(df: DataFrame, side: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{side}{c}") for c in df.columns])


def first_pairs(entries: DataFrame, limit: int) -> DataFrame:
    """``a, b``: each text with the first text of each of its files, if their fingerprints are close."""
    first = entries.groupBy("file").agg(F.min(F.struct("id", *_lanes())).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = staged(first.select("file", "first.*"), "copies_first")
    met = _sided(entries, "y_").join(_sided(first, "x_"), (F.col("x_file") == F.col("y_file")) & (F.col("x_id") < F.col("y_id")) & _within("x_", "y_", limit))
    return met.select(F.col("x_id").alias("a"), F.col("y_id").alias("b")).distinct()


def cross_pairs(entries: DataFrame, limit: int) -> DataFrame:
    """``a, b``: texts of one file and of different components ``c`` with close fingerprints.

    Those of a file's largest component are met only by those outside it.
    """
    sizes = entries.groupBy("file", "c").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("file").agg(F.max_by("c", F.struct("n", "c")).alias("most"), F.count("*").alias("parts")).filter("parts > 1")
    mixed = staged(mixed.select(F.col("file").alias("in_file"), "most"), "copies_mixed")
    known = staged(entries.join(mixed, F.col("file") == F.col("in_file")).drop("in_file"), "copies_entries")
    x, y = _sided(known.filter("c <> most"), "x_"), _sided(known, "y_")
    order = (F.col("y_c") == F.col("y_most")) | (F.col("x_id") < F.col("y_id"))
    met = x.join(y, (F.col("x_file") == F.col("y_file")) & (F.col("x_c") != F.col("y_c")) & order & _within("x_", "y_", limit))
    return met.select(F.least("x_id", "y_id").alias("a"), F.greatest("x_id", "y_id").alias("b")).distinct()


def verified(pairs: DataFrame, docs: DataFrame, row: str, words: int, likeness: float) -> DataFrame:
    """The ``pairs`` of rows whose texts have the likeness; texts travel to pairs only."""
    texts = docs.select(F.col(row).alias("row"), F.col("text").cast("string").alias("text"))
    for side in "ab":
        pairs = pairs.join(texts.select(F.col("row").alias(f"{side}_row"), F.col("text").alias(f"{side}_text")), F.col(side) == F.col(f"{side}_row"))

    def sets(column: pa.Array) -> Iterator[np.ndarray]:
        for _, data, bounds in text_chunks(column):
            hashes, owner = shingle_hashes(data, bounds, words)
            cut = np.searchsorted(owner, np.arange(len(bounds)))
            for k in range(len(bounds) - 1):
                yield np.unique(hashes[cut[k] : cut[k + 1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(sets(batch.column(2)), sets(batch.column(3)), strict=True)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[k] = both >= likeness * (len(x) + len(y) - both) and both > 0
            kept = np.flatnonzero(good)
            yield pa.RecordBatch.from_arrays([batch.column(i).take(pa.array(kept)) for i in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b", "a_text", "b_text").mapInArrow(run, "a long, b long")


def similar_groups(docs: DataFrame, row: str, words: int = WORDS, likeness: float = LIKENESS) -> DataFrame:
    """``row, doc_id, id, c`` of every row: ``id`` is the first row of equal words, ``c`` the smallest ``id`` of its group."""
    table = staged(print_table(docs, row, words), "copies_prints")
    equal = table.groupBy("k0", "k1", *_lanes()).agg(F.min("row").alias("id"))
    prints = staged(equal, "copies_texts")
    bits, tables = plan_tables(prints.count(), likeness)
    limit = radius(likeness)
    narrow = prints.select("id", *_lanes())
    links = staged(verified(staged(first_pairs(file_entries(narrow, bits, tables), limit), "copies_pairs"), docs, row, words, likeness), "copies_links")
    found = staged(components(links, "a", "b", "copies_components"), "copies_found")
    named = narrow.join(found, F.col("id") == F.col("node"), "left").select(*narrow.columns, F.coalesce("component", "id").alias("c"))
    pairs = staged(cross_pairs(file_entries(named, bits, tables), limit), "copies_pairs")
    more = staged(verified(pairs, docs, row, words, likeness), "copies_links")
    if not more.isEmpty():
        found = staged(components(links.union(more), "a", "b", "copies_components"), "copies_found")
    named = prints.join(found, F.col("id") == F.col("node"), "left").select("k0", "k1", *_lanes(), "id", F.coalesce("component", "id").alias("c"))
    same = ["k0", "k1", *[f"f{i}" for i in range(_LANES)]]
    return table.join(staged(named, "copies_named"), same).select("row", "doc_id", "id", "c")


def keep_one(docs: DataFrame, words: int = WORDS, likeness: float = LIKENESS) -> DataFrame:
    """One row of each group of similar texts."""
    row, kept = free_name(docs, "copies_row"), free_name(docs, "copies_kept")
    keyed = with_row_key(docs, row)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    best = similar_groups(keyed, row, words, likeness).groupBy("c").agg(F.min(place).alias("best"))
    return keyed.join(best.select(F.col("best.row").alias(kept)), F.col(row) == F.col(kept), "left_semi").drop(row)
