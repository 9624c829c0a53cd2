"""Conversation repair: the cheapest edits that make the roles of a conversation read ``(s?(ua)+)?``.

The rows of a conversation are taken by ``turn`` (nulls first; of equal turns in the order of the stored rows). The first fault of a
row counts: blank (nothing but white space), duplicate (role and text stood earlier), truncated (its last character
is none of ``.!?``). Edits: Keep costs 0, Rerole to user or assistant 2, Delete 3 (forced for blank and duplicate rows), Insert of an empty
text of user or assistant 2; a truncated row that stays adds 1. Of equally cheap repairs the one whose audit (first letters of the
edits, in order) is least is taken.

Method: a node is a place between rows and what the roles so far may be followed by (four states).

* Cost: least cost from each node to the end, by dynamic programming from the end, all conversations of a batch at once.
* Arcs that lie on a cheapest path stay. From a node their letters differ, since a letter and a state give the next state: so the
  least audit of one letter names one arc.
* Prefix doubling: the rank of a node among all by the first ``2 h`` letters of its least audit is the rank of the pair of ranks by
  ``h`` letters of the node itself and of the node its pointer reaches; pointers are doubled along. After log2(length) rounds the ranks order
  whole audits, and each node takes the arc with the least letter and the target of the least rank.
* The path from the start is what its doubled pointers reach, largest step first.

Conversations up to ``LONG`` rows and ``LONG_BYTES`` of text are repaired many together in one pass behind one shuffle. A longer one is cut
into pieces of ``LONG`` rows: the costs of crossing a piece from state to state (4 x 4) are summed up from the last piece
to the first, which gives the costs at the end of every piece; then each piece tells where its least path from each state comes out,
and the pieces are walked in order. So no task holds a long conversation; only its pieces' 16 numbers meet. Its
digest is taken by one task that streams over its repaired rows, since SHA-256 can't be split. Both ways give the same.

Defined cases: a null role or text is one space; a null turn sorts first and is left out of gaps; rows with a null ``conv_id`` are one
conversation. The role of an empty text has no letter, and keeping it changes nothing. Roles but those beginning with s, u and a can't be kept.
Repeated rows are duplicates. Very long texts are taken whole. A conversation without rows (``live``) has zeros, an empty audit and no
turns. An empty table gives empty ones. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportstar.llm.common import reach_workers, staged, with_row_key
from reportstar.operators.ordinals import with_ordinal

#: A conversation of more rows or bytes of text is cut into pieces of so many rows.
LONG, LONG_BYTES = 20_000, 32 << 20
#: A task repairs conversations together until it has so many rows or bytes.
BATCH_ROWS, BATCH_BYTES = 20_000, 32 << 20

BLANKS = " \t\n\x0b\f\r"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
EDITS = np.frombuffer(b"-DIKR", np.uint8)
INITIALS = {"s": 0, "u": 1, "a": 2, "": 4}
OTHER = 3
_FAR = 1 << 40

# States: nothing yet, after s, after u, after a. What keeping a role leads to; -1 where it can't be kept.
_KEPT = np.array([[1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1], [-1, -1, -1, -1], [0, 1, 2, 3]])
# What an inserted or reroled turn leads to: user, or assistant after a user.
_GIVEN = np.array([2, 2, 3, 2])
#: Cost at the end of a conversation: complete, or turns are inserted until it is.
FINISH = np.array([0, 4, 2, 0], np.int64)
_LEGAL = np.zeros((5, 5), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True

STATS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURN = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])


class Repair(NamedTuple):
    """``reports`` has a row per conversation (faults, cost, audit, digest), ``turns`` the rows that stay or are new."""

    reports: DataFrame
    turns: DataFrame


def damage(conversations: DataFrame) -> DataFrame:
    """Plant faults by ``crc32(conv_id:turn) % 20``; ``live`` is false for rows that are dropped.

    0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes its role user.
    """
    words = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    conv, turn, role, text = words
    way = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    changed = F.when(way == 1, F.lit("")).when(way == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = with_row_key(conversations, "damage_row").select(
        "conv_id", "turn", F.when(way == 4, F.lit("user")).otherwise(role).alias("role"), changed.alias("text"), (way != 0).alias("live"),
        F.explode(F.when(way == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"), "damage_row")
    return rows.withColumn("place", F.col("damage_row") * 2 + F.col("copy")).drop("damage_row", "copy")


def prepared(rows: DataFrame, live: str | None, place: str | None) -> DataFrame:
    """``conv_id, turn, place, role, text, blank, truncated, live``."""
    if place is None:
        rows, place = with_row_key(rows, "repair_row"), "repair_row"
    alive = F.coalesce(F.col(live), F.lit(False)) if live else F.lit(True)
    text = F.when(alive, F.coalesce(F.col("text").cast("string"), F.lit(" "))).otherwise("")
    bare = F.rtrim(text, F.lit(BLANKS))
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.col(place).alias("place"), F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"), (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
        alive.alias("live"),
    )


class Costs:
    """Cheapest ways through chunks of rows: ``cost[node]`` to the end of each chunk, and the least path."""

    def __init__(self, role: np.ndarray, forced: np.ndarray, truncated: np.ndarray, bounds: np.ndarray, ends: np.ndarray, last: np.ndarray):
        """``bounds`` cuts the rows into chunks; ``ends`` has the costs of the four states behind each, ``last`` whether nothing follows."""
        size = np.diff(bounds)
        count = len(size)
        self.bounds, self.count = bounds, count
        chunk = np.repeat(np.arange(count), size)
        self.rows = np.arange(len(role)) + chunk  # the place before each row
        self.ends = bounds[1:] + np.arange(count)
        places = len(role) + count
        cost = np.zeros((places, 4), np.int64)
        cost[self.ends] = ends
        kept = _KEPT[role]
        extra = truncated.astype(np.int64) + np.where(forced, _FAR, 0)
        keep_cost = np.where(kept < 0, _FAR, 0) + extra[:, None]
        kept = np.maximum(kept, 0)
        order = np.argsort(-size, kind="stable")
        longest = size[order]
        for step in range(1, int(size.max(initial=0)) + 1):
            chunks = order[: np.searchsorted(-longest, -step, "right")]
            at = self.ends[chunks] - step
            row = bounds[chunks + 1] - step
            after = cost[at + 1]
            best = np.minimum(after + 3, np.take_along_axis(after, kept[row], 1) + keep_cost[row])
            best = np.minimum(best, after[:, _GIVEN] + 2 + extra[row, None])
            for _ in range(3):
                best = np.minimum(best, 2 + best[:, _GIVEN])
            cost[at] = best
        self.cost = cost
        # Arcs of cheapest paths by letter; a letter that is no such arc is zero.
        self.letters = np.zeros((places * 4, 4), np.int8)
        self.targets = np.zeros((places * 4, 4), np.int64)
        state = np.arange(4)

        def arc(letter, at, target, weight):
            node = at[:, None] * 4 + state
            self.targets[node, letter - 1] = target
            cheapest = cost[at] == weight + cost.reshape(-1)[target]
            self.letters[node, letter - 1] = np.where(cheapest, letter, 0)

        at = self.rows
        arc(DELETE, at, at[:, None] * 4 + 4 + state, 3)
        arc(KEEP, at, at[:, None] * 4 + 4 + kept, keep_cost)
        arc(REROLE, at, at[:, None] * 4 + 4 + _GIVEN[None, :], 2 + extra[:, None])
        open_ends = self.ends[last]
        for places_at in (at, open_ends):
            arc(INSERT, places_at, places_at[:, None] * 4 + _GIVEN[None, :], 2)

    def rank_paths(self) -> None:
        """Rank the nodes by their least audits of 1, 2, 4 ... letters; choose arcs and keep the doubled pointers."""
        nodes = np.arange(len(self.letters))
        letters = np.where(self.letters > 0, self.letters, 9)
        first = letters.min(1)
        some = first < 9
        pointer = np.where(some, self.targets[nodes, np.where(some, first - 1, 0)], nodes)
        rank = np.where(some, first, 0).astype(np.int64)
        while True:
            ahead = pointer[pointer]
            if np.array_equal(ahead, pointer):
                break
            rank = np.unique(rank * (len(nodes) + 5) + rank[pointer], return_inverse=True)[1]
            pointer = ahead
        # Letter first, then the rank of what follows.
        weight = np.where(self.letters > 0, letters * np.int64(len(nodes) + 5) + rank[self.targets], np.iinfo(np.int64).max)
        choice = weight.argmin(1)
        self.edit = np.where(some, choice + 1, 0)
        self.next = np.where(some, self.targets[nodes, choice], nodes)
        self.pointers, length = [self.next], some.astype(np.int64)
        while True:
            step = self.pointers[-1]
            length = length + length[step]
            ahead = step[step]
            if np.array_equal(ahead, step):
                break
            self.pointers.append(ahead)
        self.length = length

    def start(self, entry: np.ndarray) -> np.ndarray:
        return (self.bounds[:-1] + np.arange(self.count)) * 4 + entry

    def exits(self, entry: np.ndarray) -> np.ndarray:
        """State in which the least path from each chunk's ``entry`` state leaves it."""
        node = self.start(entry)
        for step in reversed(self.pointers):
            node = step[node]
        return self.pointers[-1][node] % 4

    def path(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Edits in order: chunk, edit, row (-1 for an insert) and state reached."""
        on = np.zeros(len(self.next), bool)
        on[self.start(entry)] = True
        for step in reversed(self.pointers):
            on[step[on]] = True
        node = np.flatnonzero(on & (self.edit > 0))
        chunk = np.searchsorted(self.ends, node // 4)
        order = np.lexsort((-self.length[node], chunk))
        node, chunk = node[order], chunk[order]
        edit = self.edit[node]
        row = np.where(edit == INSERT, -1, node // 4 - chunk)
        return chunk, edit, row, self.next[node] % 4


def _strings(column) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.cast(pa.large_string())


def role_codes(role: pa.Array) -> np.ndarray:
    known = role.dictionary_encode()
    codes = np.array([INITIALS.get(r[:1], OTHER) for r in known.dictionary.to_pylist()], np.int64)
    return codes[known.indices.to_numpy(zero_copy_only=False)] if len(role) else np.zeros(0, np.int64)


def repair_batch(table: pa.Table) -> pa.RecordBatch:
    """Reports and turns of whole conversations, whose rows follow each other in order."""
    ids = table.column("conv_id").combine_chunks()
    index = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
    fresh = np.concatenate([[True], index[1:] != index[:-1]])
    heads, conv = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    alive = table.column("live").to_numpy()
    table, conv = table.filter(pa.array(alive)), conv[alive]
    count = len(heads)
    bounds = np.searchsorted(conv, np.arange(count + 1))
    role, text = _strings(table.column("role")), _strings(table.column("text"))
    codes = role_codes(role)
    seen_role, seen_text = role.dictionary_encode(), text.dictionary_encode()
    key = conv * max(len(seen_role.dictionary), 1) + seen_role.indices.to_numpy(zero_copy_only=False)
    key = key * max(len(seen_text.dictionary), 1) + seen_text.indices.to_numpy(zero_copy_only=False)
    again = np.ones(len(conv), bool)
    again[np.unique(key, return_index=True)[1]] = False
    blank = table.column("blank").to_numpy()
    again &= ~blank
    forced = blank | again
    truncated = table.column("truncated").to_numpy() & ~forced
    total = lambda flag: np.bincount(conv[flag], minlength=count)
    same = conv[1:] == conv[:-1]
    illegal = np.zeros(len(conv), bool)
    illegal[1:] = same & ~_LEGAL[codes[:-1], codes[1:]]
    turn = table.column("turn").combine_chunks()
    known = ~turn.is_null().to_numpy(zero_copy_only=False)
    number = turn.fill_null(0).to_numpy(zero_copy_only=False)
    # Nulls come first and turns ascend: a turn is new where the row before is none or has another one.
    new = known.copy()
    new[1:] &= ~(same & known[:-1] & (number[1:] == number[:-1]))
    gaps = -total(new)
    some = np.flatnonzero(total(known))
    head = np.searchsorted(conv[known], some)
    tail = np.searchsorted(conv[known], some, "right") - 1
    gaps[some] += number[known][tail] - number[known][head] + 1
    ways = Costs(codes, forced, truncated, bounds, np.tile(FINISH, (count, 1)), np.ones(count, bool))
    ways.rank_paths()
    entry = np.zeros(count, np.int64)
    chunk, edit, row, state = ways.path(entry)
    cost = ways.cost.reshape(-1)[ways.start(entry)]
    letters = EDITS[edit].tobytes().decode()
    cut = np.searchsorted(chunk, np.arange(count + 1))
    audit = [letters[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    stays = edit != DELETE
    chunk, edit, row, state = chunk[stays], edit[stays], row[stays], state[stays]
    given = pa.array(["user", "assistant", ""], pa.large_string())
    roles = pa.concat_arrays([role, given]).take(pa.array(np.where(edit == KEEP, row, len(role) + (state == 3))))
    texts = pa.concat_arrays([text, given]).take(pa.array(np.where(edit == INSERT, len(text) + 2, row)))
    marks = pa.array(["", "D", "I", "K", "R"]).take(pa.array(edit))
    turns = pa.StructArray.from_arrays([marks, roles.cast(pa.string()), texts.cast(pa.string())], fields=list(_TURN))
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(chunk, np.arange(count + 1)), pa.int32()), turns)
    stats = [gaps, total(blank), total(again), total(truncated), total(illegal), cost]
    columns = [ids.take(pa.array(heads)), *(pa.array(x.astype(np.int64)) for x in stats), pa.array(audit, pa.string()), lists]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", *STATS, "audit", "turns"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of whole conversations from batches of sorted rows."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < BATCH_ROWS and sum(b.nbytes for b in held) < BATCH_BYTES:
            continue
        table = pa.Table.from_batches(held)
        ids = table.column("conv_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))[-1])
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _schema(rows: DataFrame) -> str:
    kind = rows.schema["conv_id"].dataType.simpleString()
    return f"conv_id {kind}, {', '.join(f'{s} long' for s in STATS)}, audit string, turns array<struct<edit:string,role:string,text:string>>"


def repair_short(rows: DataFrame) -> DataFrame:
    """``conv_id, ..., audit, turns`` of conversations that fit a task; one shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole(batches):
            yield repair_batch(table)

    order = F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("place")
    dealt = rows.repartition("conv_id").sortWithinPartitions(*order)
    return dealt.mapInArrow(run, _schema(rows))


def _numbered(rows: DataFrame, piece_rows: int) -> DataFrame:
    """Rows of long conversations with their place ``pos`` in it, their piece, and all that the costs need; staged."""
    initial = F.left("role", F.lit(1))
    code = F.lit(OTHER)
    for letter, n in INITIALS.items():
        code = F.when(initial == letter, F.lit(n)).otherwise(code)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.col("place")]
    placed = with_ordinal(rows.filter("live").withColumn("name", F.md5(F.col("text").cast("binary"))), "g", order)
    starts = placed.groupBy(F.col("conv_id").alias("start_conv")).agg(F.min("g").alias("start"))
    placed = placed.join(starts, F.col("conv_id").eqNullSafe(F.col("start_conv"))).withColumn("pos", F.col("g") - F.col("start")).drop("start_conv", "start", "g")
    placed = staged(placed, "conversation_rows")
    # The first of equal rows; few rows have equals, and these are counted map-side.
    firsts = placed.groupBy(F.col("conv_id").alias("f_conv"), F.col("role").alias("f_role"), F.col("name").alias("f_name")).agg(
        F.min("pos").alias("f_pos"), F.count("*").alias("f_n")).filter("f_n > 1")
    firsts = staged(firsts, "conversation_firsts")
    equal = F.col("conv_id").eqNullSafe(F.col("f_conv")) & (F.col("role") == F.col("f_role")) & (F.col("name") == F.col("f_name"))
    marked = placed.join(firsts, equal, "left").withColumn("again", ~F.col("blank") & F.coalesce(F.col("pos") > F.col("f_pos"), F.lit(False)))
    forced = F.col("blank") | F.col("again")
    return staged(marked.select(
        "conv_id", "pos", F.floor(F.col("pos") / piece_rows).alias("piece"), "turn", "role", "text", code.alias("code"), "blank", "again", forced.alias("forced"),
        (F.col("truncated") & ~forced).alias("truncated")), "conversation_rows")


def _piece(table: pa.Table) -> tuple[np.ndarray, ...]:
    table = table.sort_by("pos")
    return tuple(table.column(c).to_numpy() for c in ("code", "forced", "truncated", "pos"))


def _keys(table: pa.Table, n: int, *names: str) -> list[pa.Array]:
    return [table.column(c).combine_chunks().take(pa.array(np.zeros(n, np.int64))) for c in names]


def _crossing(table: pa.Table) -> pa.Table:
    """Costs of crossing a piece from each state to each, its illegal neighbours and its first and last role."""
    code, forced, truncated, _ = _piece(table)
    n = len(code)
    ends = np.where(np.eye(4, dtype=bool), 0, _FAR)
    ways = Costs(*(np.tile(x, 4) for x in (code, forced, truncated)), np.arange(5) * n, ends, np.zeros(4, bool))
    costs = ways.cost[ways.bounds[:-1] + np.arange(4)].T.ravel()  # from state, to state
    illegal = int((~_LEGAL[code[:-1], code[1:]]).sum())
    values = [pa.array([costs.tolist()]), pa.array([illegal]), pa.array([int(code[0])]), pa.array([int(code[-1])])]
    return pa.table([*_keys(table, 1, "conv_id", "piece"), *values], names=["conv_id", "piece", "costs", "illegal", "head", "tail"])


def _link(table: pa.Table) -> pa.Table:
    """Costs at the end of each piece of one conversation, and its sums; from the last piece to the first."""
    table = table.sort_by("piece")
    costs = np.array(table.column("costs").to_pylist(), np.int64).reshape(-1, 4, 4)
    ends = np.zeros((len(costs), 4), np.int64)
    after = FINISH
    for k in range(len(costs) - 1, -1, -1):
        ends[k] = after
        after = (costs[k] + after).min(1)
    head, tail = table.column("head").to_numpy(), table.column("tail").to_numpy()
    illegal = table.column("illegal").to_numpy().sum() + (~_LEGAL[tail[:-1], head[1:]]).sum()
    n = len(costs)
    last = np.arange(n) == n - 1
    columns = [table.column("conv_id"), table.column("piece"), pa.array(ends.tolist()), pa.array(last), pa.array(np.full(n, illegal)), pa.array(np.full(n, after[0]))]
    return pa.table(columns, names=["conv_id", "piece", "ends", "last", "illegal", "cost"])


def _costs(table: pa.Table) -> tuple[Costs, pa.Table]:
    code, forced, truncated, pos = _piece(table)
    ends = np.array(table.column("ends")[0].as_py(), np.int64)[None, :]
    ways = Costs(code, forced, truncated, np.array([0, len(code)]), ends, np.array([table.column("last")[0].as_py()]))
    ways.rank_paths()
    return ways, pos


def _through(table: pa.Table) -> pa.Table:
    """Where the least path through a piece comes out, from each state."""
    ways, _ = _costs(table)
    exits = [int(ways.exits(np.array([q]))[0]) for q in range(4)]
    return pa.table([*_keys(table, 1, "conv_id", "piece"), pa.array([exits])], names=["conv_id", "piece", "exits"])


def _walk(table: pa.Table) -> pa.Table:
    """The state in which each piece of a conversation is entered."""
    table = table.sort_by("piece")
    entry, states = 0, []
    for exits in table.column("exits").to_pylist():
        states.append(entry)
        entry = exits[entry]
    return pa.table([table.column("conv_id"), table.column("piece"), pa.array(states, pa.int64())], names=["conv_id", "piece", "entry"])


def _edits(table: pa.Table) -> pa.Table:
    """The edits of a piece: order, edit, row, and role given."""
    ways, pos = _costs(table)
    _, edit, row, state = ways.path(np.array([table.column("entry")[0].as_py()]))
    at = np.where(row >= 0, pos[row], -1)
    letters = pa.array(["", "D", "I", "K", "R"]).take(pa.array(edit))
    given = pa.array(np.where(state == 3, "assistant", "user"))
    columns = [*_keys(table, len(edit), "conv_id", "piece"), pa.array(np.arange(len(edit))), letters, pa.array(at), given]
    return pa.table(columns, names=["conv_id", "piece", "k", "edit", "pos", "given"])


def _meet(x: DataFrame, y: DataFrame, *keys: str) -> DataFrame:
    """Join on ``conv_id`` (null meets null) and ``keys``, whose columns stay once."""
    y = y.withColumnsRenamed({c: f"y_{c}" for c in ("conv_id", *keys)})
    same = F.col("conv_id").eqNullSafe(F.col("y_conv_id"))
    for c in keys:
        same = same & (F.col(c) == F.col(f"y_{c}"))
    return x.join(y, same).drop("y_conv_id", *(f"y_{c}" for c in keys))


def _streamed(turns: DataFrame, reports: DataFrame) -> DataFrame:
    """Audit and digest of long conversations from their edits in order; rows stream through, nothing is held but the audit."""
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest, audit, some = None, hashlib.sha256(), [], False

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([at], ids), pa.array(["".join(audit)]), pa.array([digest.hexdigest()])], names=["conv_id", "audit", "sha"])

        started = False
        for batch in batches:
            ids = batch.column(0).type
            for conv, edit, role, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if not started or conv != at:
                    if started:
                        yield done()
                    at, digest, audit, some, started = conv, hashlib.sha256(), [], False, True
                audit.append(edit)
                if edit != "D":
                    digest.update(("\n" * some + f"{role}:{text}").encode())
                    some = True
        if started:
            yield done()

    dealt = turns.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), "piece", "k").select("conv_id", "edit", "role", "text")
    found = dealt.mapInArrow(run, f"conv_id {kind}, audit string, sha string")
    return _meet(reports, found)


def repair_long(rows: DataFrame, piece_rows: int) -> tuple[DataFrame, DataFrame]:
    """Reports (with ``sha``) and turns of long conversations, in pieces of ``piece_rows`` rows."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    table = _numbered(rows, piece_rows)
    piece = f"conv_id {kind}, piece long"
    narrow = table.select("conv_id", "piece", "pos", "code", "forced", "truncated")
    crossed = narrow.groupBy("conv_id", "piece").applyInArrow(_crossing, f"{piece}, costs array<long>, illegal long, head long, tail long")
    linked = staged(crossed.groupBy("conv_id").applyInArrow(_link, f"{piece}, ends array<long>, last boolean, illegal long, cost long"), "conversation_pieces")
    known = _meet(narrow, linked.drop("illegal", "cost"), "piece")
    through = known.groupBy("conv_id", "piece").applyInArrow(_through, f"{piece}, exits array<long>")
    walked = staged(through.groupBy("conv_id").applyInArrow(_walk, f"{piece}, entry long"), "conversation_entries")
    edits = _meet(known, walked, "piece").groupBy("conv_id", "piece").applyInArrow(_edits, f"{piece}, k long, edit string, pos long, given string")
    edits = staged(edits, "conversation_edits")
    old = table.select(F.col("conv_id").alias("o_conv"), F.col("pos").alias("o_pos"), F.col("role").alias("o_role"), "text")
    turns = edits.join(old, F.col("conv_id").eqNullSafe(F.col("o_conv")) & (F.col("pos") == F.col("o_pos")), "left")
    turns = turns.select(
        "conv_id", "piece", "k", "edit", F.when(F.col("edit") == "K", F.col("o_role")).otherwise(F.col("given")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    turns = staged(turns, "conversation_turns")
    flag = lambda c: F.sum(F.col(c).cast("long")).alias({"again": "duplicate"}.get(c, c))
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps")
    reports = table.groupBy("conv_id").agg(gaps, flag("blank"), flag("again"), flag("truncated"))
    sums = linked.filter("last").select("conv_id", "illegal", "cost")
    return _streamed(turns, _meet(reports, sums)).select("conv_id", *STATS, "audit", "sha"), turns


def repair(conversations: DataFrame, live: str | None = None, place: str | None = None, long_rows: int = LONG, long_bytes: int = LONG_BYTES) -> Repair:
    """Repair all conversations of ``conv_id, turn, role, text``.

    Rows whose ``live`` column isn't true are no rows, but their conversation is reported. ``place`` names a column that orders
    rows of one turn; without it the table must be a scan or a staged table, whose order counts.
    """
    reach_workers(conversations.sparkSession)
    rows = prepared(conversations, live, place)
    sizes = rows.groupBy(F.col("conv_id").alias("long_conv")).agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes"))
    # At most one in long_rows rows, or one in long_bytes bytes, names a long conversation.
    long = staged(sizes.filter((F.col("rows") > long_rows) | (F.col("bytes") > long_bytes)).select("long_conv"), "conversation_long")
    same = F.col("conv_id").eqNullSafe(F.col("long_conv"))
    some = not long.isEmpty()
    short = repair_short(rows.join(long, same, "left_anti") if some else rows)
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    reports = short.select("conv_id", *STATS, "audit", F.sha2(F.array_join(said, "\n").cast("binary"), 256).alias("repaired_sha256"))
    turns = short.select("conv_id", F.posexplode("turns").alias("n", "turn")).select("conv_id", F.col("n").cast("long").alias("n"), "turn.*")
    if not some:
        return Repair(reports, turns)
    found, pieces = repair_long(rows.join(long, same, "left_semi"), long_rows)
    # A conversation of which no row is live has no pieces.
    none = F.sha2(F.lit("").cast("binary"), 256)
    more = long.join(found, F.col("conv_id").eqNullSafe(F.col("long_conv")), "left").select(
        F.col("long_conv").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in STATS),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha", none).alias("repaired_sha256"))
    number = F.col("piece") * (1 << 32) + F.col("k")
    pieces = pieces.filter("edit <> 'D'").select("conv_id", number.alias("n"), "edit", "role", "text")
    return Repair(reports.unionByName(more), turns.unionByName(pieces))
