"""Groups of similar texts against a comparison of all pairs."""

import random
import re
from itertools import combinations
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from reportstar.llm import near_copies
from reportstar.staging import stage
from test_exact import DOCS, words

SF = Path("/root/testdata/sf0.1/documents.parquet")


def shingles(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(" ".join(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))) if w else frozenset()


def likeness(x, y):
    return len(x & y) / len(x | y) if x and y else float(x == y)


def brute_keep(rows, least=0.8):
    """Positions of the rows that stay: the first by id of each group."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        if (len(sets[i]) >= least * len(sets[j]) and len(sets[j]) >= least * len(sets[i]) or not sets[i]) and likeness(sets[i], sets[j]) >= least:
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(label[k], []).append(k)
    return sorted(min(g, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)) for g in groups.values())


def test_keep_one_of_similar_texts(spark):
    rng = random.Random(12)
    rows = [(i, words(rng, rng.randint(0, 60))) for i in range(60)]
    for k in range(12):
        base = words(rng, 150).split(" ")
        for j in range(5):
            base = list(base)  # a chain: each differs from the one before in a place
            base[rng.randrange(150)] = words(rng, 1)
            rows.append((1000 - 10 * k - j, ("\n" if j % 2 else " ").join(base).upper() if j == 3 else " ".join(base)))
    base = words(rng, 300).split(" ")
    for j in range(80):
        copy = list(base)
        copy[rng.randrange(300)] = words(rng, 1)
        rows.append((2000 + j if j else None, " ".join(copy)))
    rows += [(5, None), (None, ""), (6, " \n\t"), (7, "one two"), (8, "One\ttwo"), (8, "one two"), (9, "a b c d e"), (9, "a b c d e"), (3000, words(rng, 30_000))]
    table = stage(spark.createDataFrame([(i, t, "x", 1, f"{k}") for k, (i, t) in enumerate(rows)], DOCS).coalesce(1), "similar")
    kept = near_copies.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(int(r.simhash_row) for r in kept.collect()) == brute_keep(rows)
    assert near_copies.keep_one(table.limit(0)).collect() == []


def test_components_meet_across_files(spark, monkeypatch):
    """With one table of few bits all that is found comes from the files themselves."""
    monkeypatch.setattr(near_copies, "plan_tables", lambda *_: (1, 8))
    rng = random.Random(2)
    base = words(rng, 120).split(" ")
    rows = []
    for i in range(60):
        base = list(base)
        base[rng.randrange(120)] = words(rng, 1)
        rows.append((i, " ".join(base)))
    table = stage(spark.createDataFrame([(i, t, "x", 1, f"{i}") for i, t in rows], DOCS).coalesce(1), "chain")
    assert sorted(r.doc_id for r in near_copies.keep_one(table).collect()) == brute_keep(rows) == [0]


def test_fingerprints_agree_as_often_as_stated():
    rng = random.Random(9)
    off = []
    for _ in range(60):
        base = words(rng, 400).split(" ")
        copy = list(base)
        for k in rng.sample(range(400), 9):
            copy[k] = words(rng, 1)
        a, b = " ".join(base), " ".join(copy)
        prints, names = near_copies.fingerprints(pa.array([a, b, re.sub("[a-z]", lambda m: m[0].upper(), a).replace(" ", "\n ")]), 5)
        assert (prints[0] == prints[2]).all() and (names[0] == names[2]).all() and (names[0] != names[1]).all()
        expected = 1 - near_copies.agreement(likeness(shingles(a), shingles(b)))
        off.append(sum(int(x).bit_count() for x in prints[0] ^ prints[1]) / near_copies.BITS - expected)
    assert abs(np.mean(off)) < 0.01
    assert near_copies.radius(0.8) == 62 and near_copies.plan_tables(1000, 0.8)[0] == 14


@pytest.mark.skipif(not SF.exists(), reason="benchmark tables not present")
def test_recall_on_documents(spark):
    """All pairs of different texts at a likeness of 0.8 are in one group, but for a tenth at most."""
    docs = spark.read.parquet(str(SF)).select("doc_id", "text").collect()
    first = {}
    for r in docs:
        first.setdefault(r.text, r.doc_id)
    sets = {i: frozenset(map(hash, shingles(t))) for t, i in first.items()}
    holders = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    met = {p for h in holders.values() if len(h) < 200 for p in combinations(sorted(h), 2)}
    pairs = [p for p in met if likeness(sets[p[0]], sets[p[1]]) >= 0.8]
    table = spark.read.parquet(str(SF)).selectExpr("doc_id", "text", "monotonically_increasing_id() as row")
    group = {r.doc_id: r.c for r in near_copies.similar_groups(table, "row").collect()}
    found = sum(group[a] == group[b] for a, b in pairs)
    assert len(pairs) > 20 and found >= 0.9 * len(pairs)
