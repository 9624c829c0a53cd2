"""Passages found with edits, against a full edit-distance table."""

import random
import tracemalloc

import numpy as np
import pytest

from reportstar.llm import decontaminate as d
from reportstar.staging import stage

DOCS = "doc_id long, text string, leaks string, leaks_block0 int"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randint(2, 8))) for _ in range(n))


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.randrange(1, len(out) - 1)
        kind = rng.randrange(3)
        if kind == 0:
            out[k] = rng.choice("xyz")
        elif kind == 1:
            out.insert(k, rng.choice("xyz"))
        else:
            del out[k]
    return "".join(out)


def least_edits(passage, text):
    row = np.zeros(len(text) + 1, int)
    for i, c in enumerate(passage, 1):
        new = np.empty_like(row)
        new[0] = i
        step = np.minimum(row[:-1] + np.array([c != t for t in text]), row[1:] + 1)
        best = i
        for j, s in enumerate(step, 1):
            best = min(best + 1, s)
            new[j] = best
        row = new
    return int(row.min())


@pytest.mark.parametrize("limit", [d.BLOCK_CHARS, 300])
@pytest.mark.parametrize("part", [d.SLICE, 50])
def test_all_passages_within_the_budget(spark, monkeypatch, limit, part):
    monkeypatch.setattr(d, "SLICE", part)
    rng = random.Random(1)
    items = [(i, words(rng, rng.randint(10, 40))) for i in range(10)]
    items += [(20, items[0][1]), (21, None), (22, "  "), (23, "tiny"), (24, "der " * 30)]
    texts = []
    for k in range(60):
        passage = items[k % 10][1]
        body = changed(rng, passage, rng.randint(0, len(passage) // 7))
        texts.append(f"{words(rng, 30)} {body.upper() if k % 3 == 0 else body}\n {words(rng, 20)}")
    texts += [words(rng, 200) for _ in range(10)] + [None, "", "tiny", "der " * 500, items[3][1].replace(" ", "\n\t"), items[4][1][: len(items[4][1]) // 2]]
    table = stage(spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], DOCS), "docs")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(d.blocks, "__defaults__", (limit,))
    found = d.find_passages(table, benchmark, "_found").collect()
    got = {(r.doc_id, f.item_id): f.edits for r in found for f in r["_found"]}
    want = {}
    for i, text in enumerate(texts):
        for item, passage in items:
            p, t = d.plain(passage), d.plain(text)
            if p and t:
                most = int(d.EDITS * len(p))
                edits = least_edits(p, t)
                if edits <= most:
                    want[i, item] = edits
    assert got == want
    for r in found:
        for f in r["_found"]:
            passage = d.plain(dict(items)[f.item_id])
            assert least_edits(passage, d.plain(texts[r.doc_id])[f.start : f.start + f.length]) <= f.edits
    clean = d.drop_contaminated(table, benchmark)
    assert clean.columns == table.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {i for i, _ in want}


def test_short_passages_have_their_whole_budget():
    rng = random.Random(5)
    items = [(f"p{m}", "".join(rng.choice("abcdef") for _ in range(m))) for m in range(1, 42)]
    texts = []
    for _, passage in items:
        for _ in range(3):
            body = changed(rng, passage, int(d.EDITS * len(passage))) if len(passage) > 9 else passage
            texts.append("".join(rng.choice("uvwxyz") for _ in range(20)) + body + "".join(rng.choice("uvwxyz") for _ in range(9)))
    found = d.Passages(items).search(texts)
    for text, hits in zip(texts, found, strict=True):
        want = {i: least_edits(p, text) for i, p in items if least_edits(p, text) <= int(d.EDITS * len(p))}
        assert {h["item_id"]: h["edits"] for h in hits} == want and want


def test_many_short_texts_and_passages_fit_in_little_memory():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(40_000)]
    items = [(i, "".join(rng.choice("abcdefgh") for _ in range(14))) for i in range(10_000)]
    index = d.Passages(items)
    tracemalloc.start()
    found = index.search([*texts, "zz" + items[7][1] + "zz"])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [h["item_id"] for h in found[-1]] == [7] and peak < 400e6


def test_ids_keep_their_type(spark):
    docs = stage(spark.createDataFrame([(1, "holds a passage of some length here", "x", 1)], DOCS), "docs")
    benchmark = spark.createDataFrame([("mmlu/7", "a passage of some length")], "item_id string, text string")
    assert d.find_passages(docs, benchmark, "found").first().found[0].item_id == "mmlu/7"


def test_empty_tables(spark):
    empty = spark.createDataFrame([], DOCS)
    benchmark = spark.createDataFrame([(1, "a passage of some length")], "item_id long, text string")
    assert d.drop_contaminated(empty, benchmark).collect() == []
    one = stage(spark.createDataFrame([(1, "a passage of some length", "x", 1)], DOCS), "docs")
    assert d.drop_contaminated(one, benchmark.limit(0)).count() == 1
    assert d.drop_contaminated(one, benchmark).count() == 0
