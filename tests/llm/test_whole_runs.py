"""Maximal repeated runs of lines, found by comparing every pair of places."""

import random
import re

from reportstar.llm import linededup
from reportstar.staging import stage
from test_exact import DOCS, words


def brute_maximal(rows, least):
    """Each place's longest run that also begins at an earlier place, deleted if it has ``least`` words."""
    lines = [None if t is None else t.split("\n") for _, t in rows]
    count = [[len(re.findall(r"\S+", x, re.A)) for x in d or []] for d in lines]
    place = [[i for i, n in enumerate(c) if n] for c in count]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    rank = {k: n for n, k in enumerate(order)}
    starts = {}
    for k in order:
        for i, p in enumerate(place[k]):
            starts.setdefault(lines[k][p], []).append((k, i))
    gone = [set() for _ in rows]
    for k, d in enumerate(lines):
        for i, p in enumerate(place[k]):
            longest = 0
            for e, j in starts[d[p]]:
                if (rank[e], j) < (rank[k], i):
                    n = 0
                    while i + n < len(place[k]) and j + n < len(place[e]) and d[place[k][i + n]] == lines[e][place[e][j + n]]:
                        n += 1
                    longest = max(longest, n)
            if sum(count[k][q] for q in place[k][i : i + longest]) >= least:
                gone[k] |= set(range(p, place[k][i + longest] if i + longest < len(place[k]) else len(d)))
    kept = [None if d is None else "\n".join(x for i, x in enumerate(d) if i not in g) for d, g in zip(lines, gone, strict=True)]
    return sorted(((i, t) for (i, _), t in zip(rows, kept, strict=True)), key=repr)


def test_tails_of_runs(spark):
    run = "a line of nine words that come twice over\nshort tail"
    rows = [(1, run), (2, f"before\n{run}"), (3, f"{run}\n\nbehind"), (4, "short tail")]
    table = stage(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS).coalesce(1), "tails")
    got = {r.doc_id: (r.text, r.report.removed, r.report.runs) for r in linededup.dedup_lines(table, report="report").collect()}
    assert got == {1: (run, 0, 0), 2: ("before", 2, 1), 3: ("behind", 3, 1), 4: ("short tail", 0, 0)}


def test_maximal_runs(spark):
    rng = random.Random(19)
    pool = [words(rng, n) for n in (1, 1, 2, 2, 3, 5, 9, 12)] + ["", "  ", "end."]
    rows = [(i % 45 if i % 9 else None, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n".join(pool * 9)), (103, "\n".join(pool * 9))]
    for _ in range(40):
        k = rng.randrange(60)
        rows.append((200 + rng.randrange(30), f"{words(rng, 3)}\n{rows[k][1]}\n{words(rng, rng.randint(1, 4))}"))
    table = stage(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS).coalesce(1), "maximal")
    for least in (8, 5, 1):
        kept = linededup.dedup_lines(table, least)
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == brute_maximal(rows, least)
