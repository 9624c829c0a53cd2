"""Repeated runs of lines: later copies are deleted. DataFrame operations only.

A document is a sequence of line names (128-bit hashes of the lines that hold a word). Prefix
doubling names longer runs: the name of ``2h`` lines is the hash of the names of its halves, and any
length in between is named by two overlapping halves. Names need no exchange; grouping equal names is
the one exchange of the sequences. A suffix enters with its shortest prefix of ``min_words`` words:
suffixes that share it lie in one interval of the suffix order whose common prefix is that long.

These prefixes cover a maximal repeated run up to a tail: a last part of under ``min_words`` words, from where
a prefix reaches past the run. So the shortest run of ``min_words`` words up to each line enters as well.
In a run of that many words, a line either has ``min_words`` words from it to the end of the run, or lies in the
shortest such run up to the last line; so both kinds together cover maximal runs whole, and nothing else: each lies in
one. The same words make the same windows at every occurrence.

Every occurrence but the first (by ``doc_id``, nulls last, then row and line) is deleted, with the
blank lines that follow it. Copies in one document count. Runs of fewer words stay.
Null texts stay null, empty texts stay empty; repeated rows are copies of each other; other columns
pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.llm.common import free_name, let, staged, with_row_key

#: A run counts from so many words.
MIN_WORDS = 8


def _doubled(names: Column, h: int, i: Column) -> Column:
    """Names of ``2 h`` lines from those of ``h``; past the end a half is missing, and never asked for."""

    def pair(k: Column) -> Column:
        left, right = F.get(names, k), F.get(names, k + h)
        return F.struct(F.xxhash64(left["a"], right["a"]).alias("a"), F.xxhash64(left["b"], right["b"], F.lit(h)).alias("b"))

    return F.transform(i, pair)


def _run_name(names: dict[int, Column], m: Column, i: Column, half: str) -> Column:
    """Half of the name of ``m`` lines from ``i``: the longest power of two from both ends."""
    out = None
    for h in sorted(names):
        own = F.xxhash64(F.get(names[h], i)[half], F.get(names[h], i + m - h)[half], m)
        out = F.when(m >= h, own) if out is None else F.when(m >= h, own).otherwise(out)
    return out


def _runs(lines: Column, min_words: int) -> Column:
    """``(at, stop, k1, k2)`` of the shortest run of ``min_words`` words from each line and up to each line."""

    def with_places(w: Column, p: Column) -> Column:
        counts = F.transform(p, lambda x: F.get(w, x))
        names = F.transform(p, lambda x: F.struct(F.xxhash64(F.get(lines, x)).alias("a"), F.xxhash64(F.lit("line"), F.get(lines, x)).alias("b")))
        every = F.sequence(F.lit(0), F.size(p) - 1)
        # Lines needed: each has a word at least, so no more than min_words lines are looked at.
        none = F.struct(F.lit(0).alias("words"), F.lit(0).alias("m"))

        def needed(c: Column, i: Column) -> Column:
            return F.aggregate(
                F.slice(c, i + 1, F.lit(min_words)), none,
                lambda acc, n: F.struct((acc["words"] + n).alias("words"), (acc["m"] + (acc["words"] < min_words).cast("int")).alias("m")),
                lambda acc: F.when(acc["words"] >= min_words, acc["m"]),
            )

        def run(k: Column, m: Column, known: dict[int, Column]) -> Column:
            return F.struct(
                F.get(p, k).alias("at"), F.coalesce(F.get(p, k + m), F.size(lines)).alias("stop"),
                _run_name(known, m, k, "a").alias("k1"), _run_name(known, m, k, "b").alias("k2"),
            )

        def double(i: Column, m: Column, back: Column, known: dict[int, Column]) -> Column:
            h = max(known)
            if 2 * h <= min_words:
                return let(_doubled(known[h], h, i), lambda more: double(i, m, back, known | {2 * h: more}))
            found = F.transform(i, lambda k: F.when(F.get(m, k).isNotNull(), run(k, F.get(m, k), known)))
            # Where both ways give the same run, it enters once.
            first = lambda k: k - F.get(back, k) + 1
            more = F.transform(i, lambda k: F.when(F.get(m, first(k)) < F.get(back, k), run(first(k), F.get(back, k), known)))
            return F.filter(F.concat(found, more), lambda r: r.isNotNull())

        def windows(i: Column, c: Column, n: Column) -> Column:
            ahead = F.transform(i, lambda k: needed(c, k))
            back = let(F.reverse(c), lambda r: F.transform(i, lambda k: needed(r, F.size(p) - 1 - k)))
            return let(ahead, lambda m: let(back, lambda b: double(i, m, b, {1: n})))

        return let(every, lambda i: let(counts, lambda c: let(names, lambda n: windows(i, c, n))))

    def with_counts(w: Column) -> Column:
        places = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(w, i) > 0)
        return let(places, lambda p: F.when(F.size(p) > 0, with_places(w, p)))

    return let(F.transform(lines, lambda x: F.regexp_count(x, F.lit(r"\S+"))), with_counts)


def run_table(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Shortest runs of ``min_words`` words from and up to each line: ``doc_id, row, at, stop, k1, k2``.

    ``row`` is the row number of the scan, ``at`` and ``stop`` are line positions of the text, ``k1`` and
    ``k2`` name the run. All comes from one expression beside the row number, which keeps filters above it.
    """
    runs = F.when(F.col("text").isNotNull(), let(F.split("text", "\n", -1), lambda lines: _runs(lines, min_words)))
    return docs.select("doc_id", F.monotonically_increasing_id().alias("row"), runs.alias("runs")).select("doc_id", "row", F.inline("runs"))


def later_copies(runs: DataFrame) -> DataFrame:
    """Occurrences of a run that has an earlier one: ``row, at, stop``.

    Occurrences are reduced to the first one per name before the shuffle. The first ones are stored, so that
    the join back has plain exchanges on both sides and adaptive execution can split a frequent name.
    """
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "at")
    first = runs.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.min(place).alias("first")).filter("n > 1")
    first = staged(first.drop("n"), "first_runs")
    return runs.join(first, ["k1", "k2"]).filter(place != F.col("first")).select("row", "at", "stop")


def _left(lines: Column, gone: Column) -> Column:
    """Text without the deleted spans, lines removed and maximal runs removed."""
    spans = F.array_distinct(F.flatten(F.transform(gone, lambda s: F.sequence(s["at"], s["stop"] - 1))))
    # A run begins where a line is gone and the one before it is not.
    starts = lambda lost: F.size(F.array_except(lost, F.transform(lost, lambda p: p + 1)))
    text = lambda lost: F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost), lambda p: F.get(lines, p)), "\n")
    return let(spans, lambda lost: F.struct(text(lost).alias("text"), F.size(lost).alias("removed"), starts(lost).alias("runs")))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, report: str | None = None) -> DataFrame:
    """``docs`` with the later copies of maximal repeated runs deleted from ``text``.

    ``report`` names an added struct column ``(lines, removed, runs)``.
    """
    row, gone = free_name(docs, "line_row"), free_name(docs, "line_gone")
    keyed = with_row_key(docs, row)
    copies = later_copies(run_table(docs, min_words))
    gone_row = free_name(docs, "line_gone_row")
    deleted = copies.groupBy(F.col("row").alias(gone_row)).agg(F.collect_list(F.struct("at", "stop")).alias(gone))
    joined = keyed.join(deleted, F.col(row) == F.col(gone_row), "left")
    kept = free_name(docs, "line_kept")
    joined = joined.withColumn(kept, F.when(F.col(gone).isNotNull(), let(F.split("text", "\n", -1), lambda lines: _left(lines, F.col(gone)))))
    text = F.when(F.col(kept).isNull(), F.col("text")).otherwise(F.col(kept)["text"])
    columns = [text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    if report:
        n = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1)))
        columns.append(F.struct(n.alias("lines"), F.coalesce(F.col(kept)["removed"], F.lit(0)).alias("removed"), F.coalesce(F.col(kept)["runs"], F.lit(0)).alias("runs")).alias(report))
    return joined.select(*columns)
