"""Benchmark passages in documents, by the q-gram lemma and banded alignment.

Texts are lower-cased and runs of white space become one space. A passage of ``m`` characters may
differ by ``e = floor(EDITS * m)`` edits. By the q-gram lemma an occurrence then shares at least
``m - q + 1 - q * e`` of its q-grams with the text, all of them on ``2 e + 1`` neighbouring diagonals. ``q`` is ``Q``, or for
short passages the largest that leaves one q-gram unharmed, ``m // (e + 1)``; passages of one ``q`` share an index.
Shared q-grams are counted in overlapping bands of twice that many diagonals; bands that reach the
bound are verified by an alignment kept to the band.

The passages are taken in blocks of at most ``BLOCK_CHARS`` characters, a stated query set in blocks: each
block adds one narrow pass over the documents, without a shuffle. Null or blank passages match
nothing, null and empty documents hold nothing. Very long texts are searched whole. Repeated passages and documents are reported each;
of places with equally few edits one is reported. An ``item_id`` may have any type. Without passages nothing is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from reportstar.llm.common import RollingHash, append_column, free_name, staged, with_row_key

Q = 8
EDITS = 0.1
BLOCK_CHARS = 1 << 22
_PREFILTER = 1 << 22
#: Characters of texts that are hashed together.
TOGETHER = 1 << 18
#: Shared q-grams that are looked at at once.
SLICE = 2_000_000


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def found_type(item: T.DataType) -> T.ArrayType:
    """What is found in a text; ``item_id`` keeps its type."""
    numbers = [T.StructField(c, T.IntegerType()) for c in ("edits", "start", "length")]
    return T.ArrayType(T.StructType([T.StructField("item_id", item), *numbers]))


class Passages:
    """A block of passages, with an index for each length of q-grams that they need."""

    def __init__(self, rows: list[tuple], rate: float = EDITS):
        texts = [plain(t) for _, t in rows]
        self.ids = [i for i, _ in rows]
        # Shorter than a q-gram and without edits: found as they stand.
        self.short = [(k, t) for k, t in enumerate(texts) if 0 < len(t) < Q]
        by_q: dict[int, list[int]] = {}
        for k, t in enumerate(texts):
            if len(t) >= Q:
                by_q.setdefault(min(Q, len(t) // (int(rate * len(t)) + 1)), []).append(k)
        self.indexes = [(_Index([texts[k] for k in own], q, rate), own) for q, own in sorted(by_q.items())]

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """Passages found in each text, in the order of the block; texts are looked up ``TOGETHER`` characters at a time."""
        found: list[list[dict]] = []
        group: list[str] = []
        size = 0
        for k, text in enumerate(texts):
            group.append(plain(text))
            size += len(group[-1]) + 1
            if size >= TOGETHER or k + 1 == len(texts):
                found += self._group(group)
                group, size = [], 0
        return found

    def _group(self, texts: list[str]) -> list[list[dict]]:
        found: list[dict[int, tuple[int, int, int]]] = [{k: (0, text.find(t), len(t)) for k, t in self.short if t in text} for text in texts]
        for index, own in self.indexes:
            for mine, hits in zip(found, index.search(texts), strict=True):
                mine.update((own[k], hit) for k, hit in hits.items())
        return [[{"item_id": self.ids[k], "edits": e, "start": s, "length": n} for k, (e, s, n) in sorted(f.items())] for f in found]


class _Index:
    """Every q-gram of some plain passages with its passages and places."""

    def __init__(self, texts: list[str], q: int, rate: float):
        self.q, self.texts = q, texts
        self.codes = [codes(t) for t in texts]
        size = np.array([len(c) for c in self.codes], np.int64)
        self.edits = (rate * size).astype(np.int64)
        self.least = np.maximum(size - q + 1 - q * self.edits, 1)
        parts = [(RollingHash(c).grams(q), k) for k, c in enumerate(self.codes)]
        gram = np.concatenate([g for g, _ in parts]) if parts else np.zeros(0, np.uint64)
        item = np.concatenate([np.full(len(g), k) for g, k in parts]) if parts else np.zeros(0, np.int64)
        place = np.concatenate([np.arange(len(g)) for g, _ in parts]) if parts else np.zeros(0, np.int64)
        order = np.argsort(gram, kind="stable")
        self.item, self.place = item[order], place[order]
        self.gram, self.start = np.unique(gram[order], return_index=True)
        self.stop = np.append(self.start[1:], len(order))
        self.maybe = np.zeros(_PREFILTER, bool)
        self.maybe[(self.gram >> np.uint64(42)).astype(np.int64)] = True

    def search(self, texts: list[str]) -> list[dict[int, tuple[int, int, int]]]:
        """``passage: (edits, start, length)`` found in each of some plain texts."""
        found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
        joined = codes("\0".join(texts))
        start = np.cumsum([0, *(len(t) + 1 for t in texts)])
        if len(joined) >= self.q:
            for i, k, low in self._bands(joined, start):
                text, own = texts[i], int(self.edits[k])
                if found[i].get(k, (1,))[0] == 0:
                    continue
                width = 2 * (2 * own + 1)
                low -= int(start[i])
                at = text.find(self.texts[k], max(low, 0), max(low, 0) + width + len(self.texts[k]))
                doc = joined[start[i] : start[i + 1] - 1]
                hit = (0, at, len(self.texts[k])) if at >= 0 else align(self.codes[k], doc, low, width, own)
                if hit and hit < found[i].get(k, (own + 1,)):
                    found[i][k] = hit
        return found

    def _bands(self, joined: np.ndarray, start: np.ndarray) -> list[tuple[int, int, int]]:
        """``(text, passage, lowest diagonal)`` of the bands with enough shared q-grams.

        Diagonals are those of the joined texts, so bands of different texts never meet in one count.
        """
        grams = RollingHash(joined).grams(self.q)
        at = np.flatnonzero(self.maybe[(grams >> np.uint64(42)).astype(np.int64)])
        if not len(at):
            return []
        near = np.minimum(np.searchsorted(self.gram, grams[at]), len(self.gram) - 1)
        same = self.gram[near] == grams[at]
        at, near = at[same], near[same]
        if not len(at):
            return []
        # Slices of hits keep texts that repeat themselves within memory.
        sizes = self.stop[near] - self.start[near]
        cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE)) + 1
        slices = list(zip([0, *cuts], [*cuts, len(at)], strict=True))

        def hits(first: int, last: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            n = sizes[first:last]
            entry = np.arange(n.sum()) + np.repeat(self.start[near[first:last]] - (np.cumsum(n) - n), n)
            place = np.repeat(at[first:last], n)
            return entry, place, (np.searchsorted(start, place, "right") - 1) * len(self.codes) + self.item[entry]

        # A passage needs as many hits in the whole text as in one of its bands.
        # Only pairs with a hit are counted.
        counted = [np.unique(hits(first, last)[2], return_counts=True) for first, last in slices]
        pairs, back = np.unique(np.concatenate([p for p, _ in counted]), return_inverse=True)
        total = np.bincount(back, weights=np.concatenate([n for _, n in counted]))
        alive = pairs[total >= self.least[pairs % len(self.codes)]]
        if not len(alive):
            return []
        keys = []
        for first, last in slices:
            entry, place, pair = hits(first, last)
            kept = alive[np.minimum(np.searchsorted(alive, pair), len(alive) - 1)] == pair
            item = self.item[entry[kept]]
            band = (place[kept] - self.place[entry[kept]]) // (2 * self.edits[item] + 1)
            # A q-gram of the passage counts once in a band, however often the text repeats it.
            keys.append(_distinct(pair[kept], band, self.place[entry[kept]]))
        pair, band, place = _distinct(*np.concatenate(keys, axis=1))
        pair, band, _ = _sorted(np.concatenate([pair, pair]), np.concatenate([band, band - 1]), np.concatenate([place, place]))
        new = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (band[1:] != band[:-1])]))
        # A place may lie on both halves of a band: this count is an upper bound of the distinct ones.
        count = np.diff(np.append(new, len(pair)))
        pair, band = pair[new], band[new]
        text, item = pair // len(self.codes), pair % len(self.codes)
        enough = count >= self.least[item]
        low = band * (2 * self.edits[item] + 1)
        return list(zip(text[enough].tolist(), item[enough].tolist(), low[enough].tolist(), strict=True))


def _sorted(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
    order = np.lexsort(columns[::-1])
    return tuple(c[order] for c in columns)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Distinct rows of equally long columns."""
    rows = np.stack(_sorted(*columns))
    return rows[:, np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])] if rows.shape[1] else rows


def align(passage: np.ndarray, doc: np.ndarray, low: int, width: int, most: int) -> tuple[int, int, int] | None:
    """Fewest edits of the passage against any part of ``doc`` on diagonals ``low .. low + width - 1``.

    Returns ``(edits, start, length)``, or None above ``most`` edits. Cell ``k`` of row ``i`` stands for the
    passage's first ``i`` characters ending before position ``low + k + i``. Starts are traced only
    where the edits suffice.
    """
    far = len(passage) + width + 1
    k = np.arange(width)
    padded = np.full(width + len(passage), np.uint32(0xFFFFFFFF))
    a, b = max(low, 0), min(low + len(padded), len(doc))
    if a < b:
        padded[a - low : b - low] = doc[a:b]
    first = np.full(width + 1, far)  # a cell beyond the band
    first[:width][(low + k >= 0) & (low + k <= len(doc))] = 0
    end = low + k + len(passage)

    cost = first.copy()
    for i, c in enumerate(passage):
        # One character against another, or a passage character without partner.
        step = np.minimum(cost[:-1] + (padded[i : i + width] != c), cost[1:] + 1)
        step -= k
        np.minimum.accumulate(step, out=cost[:-1])  # text characters without partner
        cost[:-1] += k
        if i % 8 == 7 and cost.min() > most:
            return None
    cost = np.where(end <= len(doc), cost[:-1], far)
    j = int(cost.argmin())
    if cost[j] > most:
        return None

    edits, cost, origin = int(cost[j]), first.copy(), np.append(low + k, 0)
    for i, c in enumerate(passage):
        straight, up = cost[:-1] + (padded[i : i + width] != c), cost[1:] + 1
        step = np.minimum(straight, up)
        came = np.where(straight <= up, origin[:-1], origin[1:])
        step -= k
        best = np.minimum.accumulate(step)
        origin[:-1] = came[np.maximum.accumulate(np.where(step == best, k, 0))]
        cost[:-1] = best + k
    return edits, int(origin[j]), int(end[j] - origin[j])


def blocks(benchmark: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[Passages]:
    """Indexes of blocks of passages, one after the other; each block is bounded."""
    items = benchmark.filter(F.col("text").isNotNull() & (F.trim("text") != "")).select("item_id", "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // limit)
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    for b in range(n):
        yield Passages(sorted((tuple(r) for r in items.filter(part == b).collect()), key=repr))


def find_passages(docs: DataFrame, benchmark: DataFrame, name: str) -> DataFrame:
    """Add column ``name``: the passages found in each text, with edits and place in the plain text.

    A benchmark of one block is looked up in one narrow pass. Of a larger one what each block finds is stored by row before the
    next block is indexed, so the driver and a task hold one index at a time; ``docs`` must be a scan or a staged table then.
    """
    kind = found_type(benchmark.schema["item_id"].dataType)
    arrow, none = to_arrow_type(kind), F.array().cast(kind)

    def look_up(table: DataFrame, index: Passages, column: str) -> DataFrame:
        return append_column(table, "text", column, kind, lambda c: pa.array(index.search(c.to_pylist()), arrow))

    rest = blocks(benchmark)
    first, second = next(rest, None), next(rest, None)
    if first is None:
        return docs.withColumn(name, none)
    if second is None:
        return look_up(docs, first, name)
    row, hits, at = free_name(docs, "passage_row"), free_name(docs, "passage_hits"), free_name(docs, "passage_at")
    keyed = with_row_key(docs, row)
    narrow = keyed.select(F.col(row).alias("row"), "text")
    stored = [
        staged(look_up(narrow, index, "found").filter(F.size("found") > 0).select("row", F.lit(b).alias("block"), "found"), "passages")
        for b, index in enumerate(chain([first, second], rest))
    ]
    parts = F.sort_array(F.collect_list(F.struct("block", "found")))
    together = reduce(DataFrame.unionByName, stored).groupBy(F.col("row").alias(at)).agg(F.flatten(F.transform(parts, lambda p: p["found"])).alias(hits))
    joined = keyed.join(together, F.col(row) == F.col(at), "left").withColumn(name, F.coalesce(F.col(hits), none))
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], name)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs`` that hold no passage."""
    name = free_name(docs, "leaks")
    return find_passages(docs, benchmark, name).filter(F.size(name) == 0).drop(name)
