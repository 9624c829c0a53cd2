"""Repeated byte strings: every byte that a string of ``LENGTH`` bytes covers which also starts elsewhere.

Suffixes are sorted only where sorting can matter. A window of ``LENGTH`` bytes is represented by an anchor,
the start of its smallest ``GRAM``-byte hash (the leftmost of equals), so equal windows have equal anchors at
equal offsets. Then:

1. Anchors whose gram occurs once can't repeat; a count of gram hashes drops them. What shares the whole
   context of an anchor (all the windows it stands for) falls together by a 128-bit hash, which settles
   copies, however many, before any string moves.
2. Where a gram has different contexts, one suffix per distinct context goes through the merge sort. A task
   sorts its suffixes into one run per range of the gram's hash and sends it front-coded: the length of the
   prefix shared with the suffix before, and the rest. The receiving task merges the runs with a loser tree
   that carries these lengths along: of two candidates the one that shares more with the last output is the
   smaller, and equal lengths are compared only beyond them.
3. The order of the suffixes from the anchors, with its common prefixes, and the order of the reversed
   strings before the anchors tell for each offset which windows are equal.
4. Repeated windows go back to every anchor of their context, become byte spans per document and are removed.

Ranges of hashes are equally full, and copies are reduced before the exchange, so no range gets a hot group
of copies. A gram in the neighbourhood of very many different texts (a passage that a third of all documents
share) would still fill one range: its windows go, by 128-bit names, through a count that is reduced before
the exchange. Both ways are exact. Joins back to anchors have a stored table with one row per hash on one
side, which adaptive execution can split.

Null and empty texts have no bytes. Repeated rows repeat each other. Matches never cross documents; ties
don't matter, as all occurrences are removed. Other columns pass through ``remove_repeats``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.llm.common import RollingHash, free_name, mix, reach_workers, staged, text_chunks, with_row_key

LENGTH = 200
GRAM = 32
#: Distinct contexts that a merging task gets on average.
MERGE_ROWS = 10_000
#: A gram with more distinct contexts than this has its windows named and counted one by one instead.
CROWDED = 5_000
_PLACE = 20  # bits of a position in a segment
_KEY = 8  # bytes of the gram's hash before each suffix
_SPREAD = 0x9E3779B97F4A7C15  # odd, so that no two hashes meet


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours, from prefix and suffix minima of blocks."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """``text, place, lo, hi, gram hash, context hash`` of every anchor of a chunk.

    The anchor stands for the windows that start ``hi`` to ``lo`` bytes before ``place``.
    """
    parts = []
    step = (1 << _PLACE) - LENGTH
    for first in range(0, max(len(data) - LENGTH + 1, 0), step):
        segment = data[first : first + step + LENGTH - 1]
        rolling = RollingHash(segment)
        gram = rolling.grams(GRAM)
        mask = np.uint64((1 << _PLACE) - 1)
        least = _least((gram & ~mask) | np.arange(len(gram), dtype=np.uint64), LENGTH - GRAM + 1)
        place = (least & mask).astype(np.int64)
        start = np.arange(len(place), dtype=np.int64)
        text = np.searchsorted(bounds, start + first, "right") - 1
        inside = start + first + LENGTH <= bounds[text + 1]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1]) | ~inside[:-1]
        head = np.flatnonzero(new & inside)
        if not len(head):
            continue
        edge = np.flatnonzero(np.append(new | ~inside, True))
        tail = edge[np.searchsorted(edge, head, "right")] - 1
        q = place[head]
        context = rolling.slices(head, tail + LENGTH) ^ mix((q - head).astype(np.uint64) + np.uint64(1))
        parts.append((text[head], q + first - bounds[text[head]], q - tail, q - head, gram[q], context))
    if not parts:
        return tuple(np.zeros(0, t) for t in (np.int64,) * 4 + (np.uint64,) * 2)
    return tuple(np.concatenate(c) for c in zip(*parts, strict=True))


def _find_anchors(batches):
    for batch in batches:
        rows = batch.column(0).to_numpy(zero_copy_only=False)
        for first, data, bounds in text_chunks(batch.column(1)):
            text, place, lo, hi, gram, context = anchors(data, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows[first + text]), pa.array(place.astype(np.int32)), pa.array(lo.astype(np.int16)),
                    pa.array(hi.astype(np.int16)), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)),
                ],
                names=["row", "place", "lo", "hi", "gram", "context"],
            )


def shared(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return known + len(x) - (((int.from_bytes(x) ^ int.from_bytes(y)).bit_length() + 7) >> 3)


def front_code(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, bytes]:
    """Common prefix with the string before, length of the rest and the rests of a sorted run."""
    common = [0] + [shared(a, b) for a, b in zip(strings, strings[1:], strict=False)] if strings else []
    rest = [s[k:] for s, k in zip(strings, common, strict=True)]
    return np.array(common, np.uint16), np.array([len(r) for r in rest], np.uint16), b"".join(rest)


class Run:
    """A front-coded run, decoded string by string."""

    def __init__(self, common: np.ndarray, length: np.ndarray, rest: bytes):
        self.common, self.length, self.rest = common.tolist(), length.tolist(), rest
        self.at, self.offset, self.string = -1, 0, b""

    def advance(self) -> int | None:
        """Go on to the next string; its common prefix with the one before, None at the end."""
        self.at += 1
        if self.at == len(self.common):
            return None
        k, end = self.common[self.at], self.offset + self.length[self.at]
        self.string = self.string[:k] + self.rest[self.offset : end]
        self.offset = end
        return k


def merge(runs: list[Run]):
    """Yield ``(run, index, string, common prefix with the string yielded before)`` in order.

    ``height[i]`` is what the head of run ``i`` shares with the last output while it climbs, and with the
    winner over it while it rests as a loser; both are the same thing once that winner is output.
    """
    count = len(runs)
    height = [r.advance() for r in runs]
    live = sum(h is not None for h in height)

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = height[a], height[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if x != y:
            return (a, b) if x > y else (b, a)
        s, t = runs[a].string, runs[b].string
        k = shared(s, t, x)
        if k == len(s) or (k < len(t) and s[k] < t[k]):
            height[b] = k
            return a, b
        height[a] = k
        return b, a

    loser = [-1] * count
    tree = [-1] * count + [*range(count)]  # winners by node, the runs after the inner nodes
    for node in range(count - 1, 0, -1):
        tree[node], loser[node] = play(tree[2 * node], tree[2 * node + 1])
    winner = tree[1] if count > 1 else 0
    while live:
        run = runs[winner]
        yield winner, run.at, run.string, height[winner]
        height[winner] = run.advance()
        live -= height[winner] is None
        node = (winner + count) >> 1
        while node:
            winner, loser[node] = play(winner, loser[node])
            node >>= 1


def _make_runs(parts: int):
    """Sort the suffixes of a task into one front-coded run per range of gram hashes."""

    def run(batches):
        items = []
        for batch in batches:
            for raw, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for x in found:
                    q, lo, hi = x["place"], x["lo"], x["hi"]
                    # Anchors have the smallest hashes of their windows: spread them evenly again.
                    key = x["gram"] * _SPREAD % (1 << 64)
                    suffix = key.to_bytes(_KEY) + raw[q : q - lo + LENGTH]
                    items.append((suffix, raw[q - hi : q][::-1], lo, hi, x["gram"], x["context"], x["alone"]))
            if len(items) > 200_000:
                yield from _send(items, parts)
                items = []
        yield from _send(items, parts)

    return run


_RUN = [("part", pa.int32()), ("common", pa.binary()), ("length", pa.binary()), ("rest", pa.binary()),
        ("before", pa.list_(pa.binary())), ("numbers", pa.binary())]
_RUN_SCHEMA = "part int, common binary, length binary, rest binary, before array<binary>, numbers binary"
_NUMBERS = np.dtype([("lo", "<i2"), ("hi", "<i2"), ("alone", "<i2"), ("gram", "<i8"), ("context", "<i8")])


def _send(items: list, parts: int):
    items.sort(key=lambda x: x[0])
    rows, first = [], 0
    part = [(int.from_bytes(x[0][:_KEY]) * parts) >> 64 for x in items]
    for last in [*np.flatnonzero(np.diff(part)) + 1, len(items)] if items else []:
        own = items[first:last]
        common, length, rest = front_code([x[0] for x in own])
        numbers = np.array([(x[2], x[3], x[6], x[4], x[5]) for x in own], _NUMBERS)
        rows.append({"part": part[first], "common": common.tobytes(), "length": length.tobytes(), "rest": rest,
                     "before": [x[1] for x in own], "numbers": numbers.tobytes()})
        first = last
    yield pa.RecordBatch.from_pylist(rows, pa.schema(_RUN))


def repeated_windows(common: np.ndarray, before: list[bytes], lo: np.ndarray, hi: np.ndarray) -> list[list[tuple[int, int]]]:
    """For suffixes in sorted order, the offsets ``a`` whose window occurs at another one, as ranges.

    The window of offset ``a`` has ``a`` bytes before the anchor and ``LENGTH - a`` from it on. It is equal
    for neighbours in the suffix order that share that much and, of these, for neighbours in the order of
    the reversed strings before that share ``a`` bytes.
    """
    n = len(before)
    group = np.cumsum(common < _KEY + GRAM)
    names = group.tolist()
    order = sorted(range(n), key=lambda i: (names[i], before[i]))
    back = np.full(n, -1)
    for j in range(1, n):
        x, y = order[j - 1], order[j]
        if names[x] == names[y]:
            back[j] = shared(before[x], before[y])
    order = np.array(order)
    found: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    open_since = np.full(n, -1)
    for a in range(int(lo.min()), int(hi.max()) + 2):
        there = np.flatnonzero((lo <= a) & (a <= hi))
        now = np.zeros(n, bool)
        if len(there):
            forward = np.cumsum(common < _KEY + LENGTH - a)
            backward = np.empty(n, np.int64)
            backward[order] = np.cumsum(back < a)
            key = forward[there] * (n + 1) + backward[there]
            _, at, count = np.unique(key, return_inverse=True, return_counts=True)
            now[there] = count[at] > 1
        for i in np.flatnonzero(~now & (open_since >= 0)):
            found[i].append((int(open_since[i]), a - 1))
            open_since[i] = -1
        open_since[now & (open_since < 0)] = a
    return found


#: Numbers that stand for the bytes in the second hash of a window: no linear function of the bytes, so neither hash gives the other.
_SHUFFLED = np.random.default_rng(128).permutation(256).astype(np.uint8)

_WINDOW_SCHEMA = "h1 long, h2 long, gram long, context long, lo short, hi short, a int"


def _name_windows(batches):
    """128-bit names of all windows of the contexts of crowded grams: two hashes, the second of other numbers for the bytes."""
    for batch in batches:
        for raw, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for x in found:
                a = np.arange(x["lo"], x["hi"] + 1)
                data = np.frombuffer(raw[x["place"] - x["hi"] : x["place"] - x["lo"] + LENGTH], np.uint8)
                start = x["hi"] - a
                names = [RollingHash(x).slices(start, start + LENGTH) for x in (data, _SHUFFLED[data])]
                same = lambda k: pa.array(np.full(len(a), x[k]))  # noqa: B023, E731
                columns = [*(pa.array(n.view(np.int64)) for n in names), same("gram"), same("context")]
                columns += [same("lo").cast(pa.int16()), same("hi").cast(pa.int16()), pa.array(a.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["h1", "h2", "gram", "context", "lo", "hi", "a"])


def _crowded_spans(texts: DataFrame, contexts: DataFrame) -> DataFrame:
    """Spans of the contexts of crowded grams, from counts of equal windows."""
    windows = staged(texts.join(_by_row(contexts), "row").select("text", "suffixes").mapInArrow(_name_windows, _WINDOW_SCHEMA), "windows")
    twice = staged(windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).filter("n > 1").drop("n"), "repeated_windows")
    span = F.struct((-F.col("a")).alias("start"), (F.lit(LENGTH) - F.col("a")).alias("stop"))
    found = windows.join(twice, ["h1", "h2"]).groupBy("gram", "context", "lo", "hi").agg(F.collect_list(span).alias("spans"))
    return found.select("gram", "context", F.col("lo").cast("int").alias("lo"), F.col("hi").cast("int").alias("hi"), "spans")


def _by_row(contexts: DataFrame) -> DataFrame:
    """One occurrence of each context, gathered by the row of its text."""
    suffix = F.struct(F.col("one.place").alias("place"), "lo", "hi", "gram", "context", (F.col("n") == 1).cast("int").alias("alone"))
    return contexts.groupBy(F.col("one.row").alias("row")).agg(F.collect_list(suffix).alias("suffixes"))


_SPAN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
_SPAN_SCHEMA = "gram long, context long, lo int, hi int, spans array<struct<start:int,stop:int>>"


def _merge_runs(table: pa.Table) -> pa.Table:
    """Spans, relative to the anchor, of the contexts of one range of gram hashes that occur once."""
    raw = table.select(["common", "length", "rest", "before", "numbers"]).to_pylist()
    runs = [Run(np.frombuffer(r["common"], np.uint16), np.frombuffer(r["length"], np.uint16), r["rest"]) for r in raw]
    numbers = [np.frombuffer(r["numbers"], _NUMBERS) for r in raw]
    common, before, own = [], [], []
    for run, index, _, k in merge(runs):
        common.append(k)
        before.append(raw[run]["before"][index])
        own.append(numbers[run][index])
    rows = []
    if own:
        own = np.array(own, _NUMBERS)
        found = repeated_windows(np.array(common), before, own["lo"], own["hi"])
        for x, ranges in zip(own, found, strict=True):
            if ranges and x["alone"]:
                spans = [{"start": -b, "stop": LENGTH - a} for a, b in ranges]
                rows.append({"gram": int(x["gram"]), "context": int(x["context"]), "lo": int(x["lo"]), "hi": int(x["hi"]), "spans": spans})
    return pa.Table.from_pylist(rows, pa.schema([("gram", pa.int64()), ("context", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32()), ("spans", _SPAN)]))


def repeats(keyed: DataFrame, row: str) -> DataFrame:
    """Byte spans that repeat: ``row`` and ``spans``, which may overlap; rows without any are absent."""
    texts = keyed.select(F.col(row).alias("row"), F.col("text").cast("string").cast("binary").alias("text"))
    schema = "row long, place int, lo short, hi short, gram long, context long"
    all_anchors = staged(texts.filter(F.length("text") >= LENGTH).mapInArrow(_find_anchors, schema), "anchors")
    grams = all_anchors.groupBy("gram").agg(F.count("*").alias("n"), (F.min("context") != F.max("context")).alias("mixed"))
    grams = staged(grams.filter("n > 1").drop("n"), "grams")
    kept = staged(all_anchors.join(grams, "gram"), "repeated_grams")
    key = ["gram", "context", "lo", "hi"]
    classes = kept.groupBy(*key).agg(F.count("*").alias("n"), F.any_value("mixed").alias("mixed"), F.min(F.struct("row", "place")).alias("one"))
    classes = staged(classes, "contexts")
    mixed = classes.filter("mixed")
    crowded = staged(mixed.groupBy("gram").agg(F.count("*").alias("contexts")).filter(F.col("contexts") > CROWDED), "crowded_grams")
    parts = max(1, -(-mixed.count() // MERGE_ROWS))
    wanted = _by_row(mixed.join(crowded, "gram", "left_anti"))
    runs = texts.join(wanted, "row").select("text", "suffixes").mapInArrow(_make_runs(parts), _RUN_SCHEMA)
    merged = runs.groupBy("part").applyInArrow(_merge_runs, _SPAN_SCHEMA)
    if crowded.count():
        merged = merged.unionByName(_crowded_spans(texts, mixed.join(crowded, "gram", "left_semi").filter("mixed")))
    whole = F.array(F.struct((-F.col("hi").cast("int")).alias("start"), (F.lit(LENGTH) - F.col("lo").cast("int")).alias("stop")))
    copies = classes.filter("n > 1").select(*key, whole.alias("spans"))
    merged = merged.select("gram", "context", F.col("lo").cast("short").alias("lo"), F.col("hi").cast("short").alias("hi"), "spans")
    spans = staged(copies.unionByName(merged), "repeated_contexts")
    found = kept.join(spans, key).select("row", "place", F.explode("spans").alias("s"))
    span: Column = F.struct((F.col("place") + F.col("s.start")).alias("start"), (F.col("place") + F.col("s.stop")).alias("stop"))
    return staged(found.groupBy("row").agg(F.collect_list(span).alias("spans")), "repeats")


def without(raw: bytes, spans: list[dict]) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal removed runs."""
    parts, at, runs, stop = [], 0, 0, -1
    for s in sorted(spans, key=lambda s: s["start"]):
        if s["start"] > stop:
            parts.append(raw[at : s["start"]])
            runs += 1
        stop = max(stop, s["stop"])
        at = stop
    return b"".join(parts) + raw[at:], runs


def remove_repeats(docs: DataFrame, name: str = "repeats") -> DataFrame:
    """``docs`` with struct column ``name`` (``n_bytes, n_removed, n_spans, kept``); ``kept`` is binary.

    ``kept`` may split a character where a repeated string does. If ``name`` is taken, underscores are
    put before it.
    """
    row, spans, name = free_name(docs, "suffix_row"), free_name(docs, "suffix_spans"), free_name(docs, name)
    found_row = free_name(docs, "suffix_found_row")
    reach_workers(docs.sparkSession)
    keyed = with_row_key(docs, row)
    found = repeats(keyed, row).select(F.col("row").alias(found_row), F.col("spans").alias(spans))
    joined = keyed.join(found, F.col(row) == F.col(found_row), "left").drop(row, found_row)
    kind = T.StructType().add("n_bytes", "long").add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    schema = joined.drop(spans).schema.add(name, kind)

    def cut(batches):
        for batch in batches:
            at, text = batch.schema.get_field_index(spans), batch.column(batch.schema.get_field_index("text"))
            rows = []
            for raw, own in zip(text.cast(pa.binary()).to_pylist(), batch.column(at).to_pylist(), strict=True):
                raw = raw or b""
                left, n = without(raw, own or [])
                rows.append((len(raw), len(raw) - len(left), n, left))
            own = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
            others = [i for i in range(batch.num_columns) if i != at]
            columns = [*(batch.column(i) for i in others), pa.StructArray.from_arrays(own, kind.names)]
            yield pa.RecordBatch.from_arrays(columns, names=[*(batch.schema.names[i] for i in others), name])

    return joined.mapInArrow(cut, schema)
