"""Spelling variants: words that differ by one letter, found by PartEnum signatures of their letters.

A word is a maximal run of Latin letters with A-Z in lower case. Its letters, taken as a multiset, are a binary vector with
one dimension per letter and occurrence. One inserted or deleted letter changes one dimension, one replaced letter two, so near
words have vectors within Hamming distance two. Words of the same letters (anagrams) have distance zero and are never near: they
form a class, and classes are what is compared.

* Partition: a fixed hash deals the dimensions into ``PARTS`` parts. Two differing dimensions touch at most two of them.
* Enumerate: a signature for each choice of ``PARTS - 2`` parts, so that classes within distance two share one for certain.
* Equi-join on signatures. A bit sketch of the vectors rejects most of what meets, and a pair is taken at its first
  common signature only. Two sums of the letters tell which letter is replaced by which, and the classes without these must be equal.
* Verify the words: each pair of classes asks for words of both without the letter in question. What is asked of a class
  is reduced to distinct letters first, so a word has at most two entries per place, and words of equal entries are near. No
  pairs of words are made but near ones, however many anagrams a class has.

A word's form is its most frequent near word, if that is ``RATIO`` times as frequent; forms of forms lead to the root.
Pointers to forms are doubled until all are at a root; a form is more frequent than its word by that factor, so there are few rounds.

Defined cases: null and empty texts hold no word; a null ``doc_id`` counts as an empty text in the seed of the damage.
Very long texts and runs are taken whole. Ties go to the word that is smallest in code-point order. Repeated rows count
as often as they stand. An empty table has no words. Columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.llm.common import mix, reach_workers, staged
from reportstar.llm.url_filter import lower
from reportstar.operators.ordinals import with_ordinal

#: Words count from so many code points and occurrences.
MIN_CHARS, MIN_COUNT = 6, 5
#: A form is at least so many times as frequent as its word.
RATIO = 5
#: Parts of the dimensions; a signature covers all but two of them.
PARTS = 7
LETTERS = "A-Za-zÀ-ÿ"
CHOICES = list(combinations(range(PARTS), PARTS - 2))


def letter_runs(min_chars: int = MIN_CHARS, damage: int | None = None) -> Column:
    """The runs of at least ``min_chars`` letters of ``text``, one letter short where ``damage`` divides their seed.

    Shorter runs are no words with or without damage, so the pattern leaves them out.
    """
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"([{LETTERS}]{{{min_chars},}})"), F.lit(1))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))

    def hurt(run: Column) -> Column:
        seed = F.crc32(F.concat(key, F.lit(":"), run).cast("binary"))
        at = (seed % F.length(run)).cast("int")
        cut = F.concat(F.left(run, at), F.substr(run, at + 2))
        return F.when(seed % damage == 0, cut).otherwise(run)

    lowered = F.transform(runs, lower)
    return F.transform(lowered, hurt) if damage else lowered


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, damage: int | None = None) -> DataFrame:
    """``word, n`` of all words long and frequent enough; counted map-side before the one shuffle."""
    words = docs.select(F.explode(letter_runs(min_chars, damage)).alias("word"))
    counts = words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count("*").alias("n"))
    return counts.filter(F.col("n") >= min_count)


def _letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, each word's sorted, with the word's number and the bounds of words."""
    texts = words.to_pylist()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    return codes[np.lexsort((codes, owner))], owner, np.concatenate([[0], np.cumsum(sizes)])


def letter_classes(words: pa.Array) -> pa.Array:
    """The letters of each word in order: the name of its class."""
    codes, _, bounds = _letters(words)
    text = codes.astype("<u4").tobytes().decode("utf-32-le")
    return pa.array([text[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.string())


def vectors(classes: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each part, bit sketch, and sums of the letters and of their squares, of each class."""
    codes, owner, bounds = _letters(classes)
    n, at = len(bounds) - 1, np.arange(len(codes))
    fresh = np.ones(len(codes), bool)
    fresh[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
    dimension = mix((codes.astype(np.uint64) << np.uint64(32)) + occurrence.astype(np.uint64) + np.uint64(1))
    parts = np.zeros((n, PARTS), np.uint64)
    np.add.at(parts, (owner, (dimension >> np.uint64(40)) % np.uint64(PARTS)), mix(dimension.copy()))
    sketch = np.zeros(n, np.uint64)
    np.bitwise_xor.at(sketch, owner, np.uint64(1) << (dimension >> np.uint64(58)))
    total, square = np.zeros(n, np.int64), np.zeros(n, np.int64)
    np.add.at(total, owner, codes)
    np.add.at(square, owner, codes * codes)
    return parts, sketch, total, square


def signatures(parts: np.ndarray) -> np.ndarray:
    """One signature per choice of parts."""
    out = np.zeros((len(parts), len(CHOICES)), np.uint64)
    for k, chosen in enumerate(CHOICES):
        h = np.full(len(parts), k + 1, np.uint64)
        for j in chosen:
            h = mix(h * np.uint64(0x9E3779B97F4A7C15) + parts[:, j])
        out[:, k] = h
    return out


def _lists(values: np.ndarray) -> pa.Array:
    rows, width = values.shape
    return pa.ListArray.from_arrays(np.arange(0, rows * width + 1, width, dtype=np.int32), pa.array(values.view(np.int64).ravel()))


def with_classes(words: DataFrame) -> DataFrame:
    """``word, n, wid, class``; ``wid`` numbers the words in code-point order."""
    numbered = with_ordinal(words, "wid", [F.col("word")]).select("word", "n", "wid")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, letter_classes(batch.column(0))], names=["word", "n", "wid", "class"])

    reach_workers(words.sparkSession)
    return numbered.mapInArrow(run, "word string, n long, wid long, class string")


def enumerate_signatures(classes: DataFrame) -> DataFrame:
    """``class, parts, sketch, total, square, sig`` of each distinct class; ``sig`` lists its signatures."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, sketch, total, square = vectors(batch.column(0))
            numbers = [pa.array(x) for x in (sketch.view(np.int64), total, square)]
            columns = [batch.column(0), _lists(parts), *numbers, _lists(signatures(parts))]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "parts", "sketch", "total", "square", "sig"])

    reach_workers(classes.sparkSession)
    return classes.mapInArrow(run, "class string, parts array<long>, sketch long, total long, square long, sig array<long>")


def _without(letters: Column, letter: Column) -> Column:
    """Sorted letters less one occurrence of ``letter``, which must be among them; else NULL."""
    at = F.position(letter, letters)
    return F.when(at > 0, F.concat(F.left(letters, at - 1), F.substr(letters, at + 1)))


def class_pairs(signed: DataFrame) -> DataFrame:
    """``a, b, lost, gained``: pairs of classes where one letter turns ``a`` into ``b``.

    Either ``b`` has one letter ``gained`` more (``lost`` is empty), or ``gained`` stands in place of ``lost``.
    """
    entries = signed.select("class", F.length("class").alias("size"), "parts", "sketch", "total", "square", F.posexplode("sig").alias("k", "sig"))
    x, y = (entries.select(*(F.col(c).alias(f"{s}_{c}") for c in entries.columns)) for s in "xy")
    longer = F.col("y_size") - F.col("x_size")
    order = (longer == 1) | ((longer == 0) & (F.col("x_class") < F.col("y_class")))
    near = F.bit_count(F.col("x_sketch").bitwiseXOR(F.col("y_sketch"))) <= 2
    met = x.join(y, (F.col("x_sig") == F.col("y_sig")) & (F.col("x_k") == F.col("y_k")) & order & near)
    # The first choice whose parts are all equal, so that a pair is taken once.
    same = [F.get("x_parts", F.lit(j)) == F.get("y_parts", F.lit(j)) for j in range(PARTS)]
    first = F.lit(len(CHOICES))
    for k in reversed(range(len(CHOICES))):
        equal = same[CHOICES[k][0]]
        for j in CHOICES[k][1:]:
            equal = equal & same[j]
        first = F.when(equal, F.lit(k)).otherwise(first)
    met = met.filter(F.col("x_k") == first)
    # gained - lost and gained^2 - lost^2 give both letters, all of which are below U+0100. Wrong guesses fail the comparison.
    change = F.col("y_total") - F.col("x_total")
    both = F.expr("(y_square - x_square) div nullif(y_total - x_total, 0)")
    inserted = longer == 1
    gained = F.when(inserted, change).otherwise(F.floor((change + both) / 2))
    lost = F.when(inserted, F.lit(0)).otherwise(gained - change)
    named = met.filter((gained > 0) & (gained < 256) & (lost >= 0) & (lost < 256)).select(
        F.col("x_class").alias("a"), F.col("y_class").alias("b"), inserted.alias("inserted"),
        F.when(inserted, F.lit("")).otherwise(F.chr(lost)).alias("lost"), F.chr(gained).alias("gained"),
    )
    rest = F.when(F.col("inserted"), F.col("a")).otherwise(_without(F.col("a"), F.col("lost")))
    return named.filter(rest == _without(F.col("b"), F.col("gained"))).drop("inserted")


def near_words(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``wid, near, near_n``: each word with each word that differs by one letter.

    A word is entered under a 128-bit name of what is left of it without an asked letter: with the place of a
    replaced letter, without it for an inserted one (of equal letters in a row the first), and whole where
    a longer word may have one more. Near words share exactly one entry, and words that share one are near.
    """
    asked = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("class"), F.when(F.col("lost") == "", "whole").otherwise("mask").alias("kind"), F.col("lost").alias("letter")),
        F.struct(F.col("b").alias("class"), F.when(F.col("lost") == "", "drop").otherwise("mask").alias("kind"), F.col("gained").alias("letter")),
    )))
    # At most two entries per letter and one more; a class is one row then.
    asked = asked.distinct().groupBy("class").agg(F.collect_list(F.struct("kind", "letter")).alias("asked"))
    word, kind, letter = F.col("word"), F.col("ask.kind"), F.col("ask.letter")
    rows = words.join(asked, "class").select("wid", "n", "word", F.explode("asked").alias("ask"))
    place = F.filter(
        F.sequence(F.lit(1), F.length(word)),
        lambda p: (F.substr(word, p, F.lit(1)) == letter) & ((kind == "mask") | (p == 1) | (F.substr(word, F.greatest(p - 1, F.lit(1)), F.lit(1)) != letter)),
    )
    place = F.when(kind == "whole", F.array(F.lit(0))).otherwise(place)
    rows = rows.select("wid", "n", "word", F.col("ask.kind").alias("kind"), F.explode(place).alias("p"))
    left, right = F.left(word, F.greatest(F.col("p") - 1, F.lit(0))), F.substr(word, F.col("p") + 1)
    masked = F.col("kind") == "mask"
    bare = F.when(masked, F.concat(left, F.lit("*"), right)).when(F.col("kind") == "whole", word).otherwise(F.concat(left, right))
    names = F.xxhash64(bare).alias("e1"), F.xxhash64(F.lit("second"), bare).alias("e2")
    entries = rows.select("wid", "n", F.col("kind").alias("kind"), *names)
    x, y = (entries.select(*(F.col(c).alias(f"{s}_{c}") for c in entries.columns)) for s in "xy")
    fits = ((F.col("x_kind") == "mask") & (F.col("y_kind") == "mask")) | (
        (F.col("x_kind") != F.col("y_kind")) & (F.col("x_kind") != "mask") & (F.col("y_kind") != "mask"))
    same = (F.col("x_e1") == F.col("y_e1")) & (F.col("x_e2") == F.col("y_e2")) & (F.col("x_wid") != F.col("y_wid"))
    return x.join(y, same & fits).select(F.col("x_wid").alias("wid"), F.col("y_wid").alias("near"), F.col("y_n").alias("near_n"))


def follow(forms: DataFrame) -> DataFrame:
    """``wid, root``: the last word reached from each word by its forms ``wid, form``, by doubled pointers."""
    steps = staged(forms.select("wid", F.col("form").alias("root")), "spelling_roots")
    while True:
        ahead = steps.select(F.col("wid").alias("at"), F.col("root").alias("ahead"))
        joined = steps.join(ahead, F.col("root") == F.col("at"), "left")
        moved = joined.select("wid", F.coalesce("ahead", "root").alias("root"), F.col("ahead").isNotNull().alias("moved"))
        moved = staged(moved, "spelling_roots")
        steps = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return steps


def group_variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO, damage: int | None = None) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs``.

    ``damage`` plants misspellings: a run loses a letter where it divides the CRC-32 of ``doc_id:run``.
    """
    words = staged(with_classes(count_words(docs, min_chars, min_count, damage)), "spelling_words")
    signed = staged(enumerate_signatures(words.select("class").distinct()), "spelling_classes")
    pairs = staged(class_pairs(signed), "spelling_pairs")
    found = near_words(words, pairs).groupBy("wid").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    found = words.select("word", "n", "wid").join(found, "wid", "left")
    holds = -F.col("best.minus") >= ratio * F.col("n")
    found = found.select("wid", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(holds, F.col("best.near")).alias("form"))
    found = staged(found, "spelling_forms")
    roots = follow(found.filter("form is not null").select("wid", "form"))
    named = words.select(F.col("wid").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n"))
    ends = words.select(F.col("wid").alias("root"), F.col("word").alias("root_word"))
    out = found.join(roots, "wid", "left").join(named, "form", "left").join(ends, "root", "left")
    return out.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")
