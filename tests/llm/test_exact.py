"""Suffix dedup, line dedup, SimHash groups and embedding groups against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from reportstar.llm import embed_dedup, linededup, simhash, suffix_dedup
from reportstar.llm.common import RollingHash, components, with_row_key
from reportstar.staging import stage

DOCS = "doc_id long, text string, line_row string, suffix_row int, simhash_row string"


def docs(spark, rows):
    """A stored table with columns whose names the operators use inside."""
    return stage(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS), "docs")


def words(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    passage, long = words(rng, 70), words(rng, 30_000)
    rows = [(i, words(rng, rng.randint(0, 120))) for i in range(30)]
    rows += [(i, f"{words(rng, 20)}\n{passage}\n{words(rng, rng.randint(0, 40))}") for i in range(30, 60)]
    rows += [(60, long), (61, long[:90_000] + " changed " + long[90_000:]), (62, None), (63, ""), (64, None), (65, " \n\n")]
    rows += [(66, "der " * 400), (67, "x der " + "der " * 100), (68, "ab" * 99), (69, "ab" * 101), (70, passage), (70, passage), (None, passage)]
    return rows


def brute_repeats(rows, length):
    raw = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for (doc_id, _), b in zip(rows, raw, strict=True):
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        mask = np.cumsum(gone)[:-1] > 0
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        runs = int((np.diff(np.concatenate([[0], mask.astype(int)])) == 1).sum())
        out.append((doc_id, len(b), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("crowded", [5000, 3])
def test_suffix_dedup(spark, texts, monkeypatch, crowded):
    monkeypatch.setattr(suffix_dedup, "CROWDED", crowded)
    monkeypatch.setattr(suffix_dedup, "MERGE_ROWS", 50)
    found = suffix_dedup.remove_repeats(docs(spark, texts)).collect()
    got = [(r.doc_id, *r.repeats[:3], hashlib.sha256(r.repeats.kept).hexdigest()) for r in found]
    assert sorted(got, key=repr) == brute_repeats(texts, 200)


def test_the_two_hashes_of_a_window_do_not_determine_each_other():
    """Windows whose bytes have equal sums, weighted as in the first hash, differ in the second, and no constant relates both."""
    rng = np.random.default_rng(6)
    windows = rng.integers(0, 256, (300, 200)).astype(np.uint8)
    names = []
    for w in windows:
        first, second = (RollingHash(x) for x in (w, suffix_dedup._SHUFFLED[w]))
        names.append((int(first.sums[-1]), int(second.sums[-1])))
    sums = {(a + b) % 2**64 for a, b in names}
    gaps = {(a - b) % 2**64 for a, b in names}
    assert len(sums) == len(gaps) == 300
    # A change of two bytes that leaves their sum shows in the second hash.
    assert any(int(suffix_dedup._SHUFFLED[i]) + int(suffix_dedup._SHUFFLED[j]) != int(suffix_dedup._SHUFFLED[i + 1]) + int(suffix_dedup._SHUFFLED[j - 1]) for i, j in ((3, 9), (40, 99), (100, 30)))


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.remove_repeats(docs(spark, [])).collect() == []
    assert suffix_dedup.remove_repeats(docs(spark, [(1, None), (2, "short")])).count() == 2


def test_merge_of_front_coded_runs():
    rng = random.Random(1)
    pool = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    for count in (1, 2, 3, 7, 16):
        parts = [sorted(pool[k::count]) for k in range(count)]
        parts.append([])
        got = list(suffix_dedup.merge([suffix_dedup.Run(*suffix_dedup.front_code(p)) for p in parts]))
        assert [s for _, _, s, _ in got] == sorted(pool)
        assert all(parts[r][i] == s for r, i, s, _ in got)
        assert all(k == suffix_dedup.shared(a[2], b[2]) for a, b in zip(got, got[1:], strict=False) for k in (b[3],))


def test_line_dedup_keeps_columns(spark):
    table = docs(spark, [(1, "a"), (2, None)])
    assert linededup.dedup_lines(table, report="report").columns == [*table.columns, "report"]
    assert linededup.dedup_lines(docs(spark, [])).collect() == []


def fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def test_simhash_groups(spark, texts):
    rng = random.Random(3)
    rows = list(texts)
    base = words(rng, 400).split(" ")
    for i in range(100, 160):
        copy = list(base)
        copy[rng.randrange(400)] = words(rng, 1)
        rows.append((i, "\t".join(copy).upper() if i % 7 == 0 else " ".join(copy)))
    rows += [(200, "two words"), (201, "Two  words"), (202, "one"), (203, "a b c")]
    table = with_row_key(docs(spark, rows), "row")
    got = {(r.doc_id, r.f % (1 << 64), r.component_id) for r in simhash.group_documents(table, "row").collect()}
    prints = [(i, fingerprint(t)) for i, t in rows]
    label = {f: f for _, f in prints}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                if (a ^ b).bit_count() <= 2 and label[b] < label[a]:
                    label[a], changed = label[b], True
    least = {}
    for i, f in prints:
        if i is not None:
            least[label[f]] = min(i, least.get(label[f], i))
    assert got == {(i, f, least[label[f]]) for i, f in prints}
    kept = simhash.keep_one(docs(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(least.values())
    assert simhash.keep_one(docs(spark, [])).collect() == []


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 480)] + [(500, i) for i in range(501, 560)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = components(spark.createDataFrame(edges, "a long, b long"), "a", "b")
    assert {tuple(r) for r in found.collect()} == {(x, label[x]) for x in label if label[x] != x}


def brute_vectors(rows, least=0.9):
    good = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.array(v, np.float32).astype(float)
            good[k] = x / np.linalg.norm(x)
    links = {k: {j for j in good if j != k and len(good[j]) == len(good[k]) and good[j] @ good[k] >= least} for k in good}
    label = {k: k for k in good}
    for _ in good:
        for k in good:
            label[k] = min([label[k], *(label[j] for j in links[k])])
    group = {}
    for k in good:
        if rows[k][0] is not None:
            group[label[k]] = min(rows[k][0], group.get(label[k], rows[k][0]))
    out = []
    for k, (i, _) in enumerate(rows):
        c = group.get(label[k]) if k in good else i
        out.append((i, len(links.get(k, ())), c, i is not None and i == c))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [1024, 40])
def test_embedding_groups(spark, monkeypatch, block):
    monkeypatch.setattr(embed_dedup, "BLOCK", block)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 32))
    near = np.repeat(base[:1], 150, 0) + 0.05 * rng.normal(size=(150, 32))
    more = np.repeat(base[1:20], 3, 0) + 0.1 * rng.normal(size=(57, 32))
    vectors = [*base, *near, *more, base[0], base[0], 3 * base[5]]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, []), (902, [0.0] * 32), (903, [float("nan")] * 32), (904, [None] + [1.0] * 31), (905, [float("inf")] * 32)]
    rows += [(906, [1.0, 0.0]), (907, [2.0, 0.0]), (None, rows[3][1]), (908, [5.0]), (909, [5.0]), (909, [5.0])]
    table = stage(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vectors")
    got = sorted((tuple(r) for r in embed_dedup.group_vectors(table).collect()), key=repr)
    assert got == brute_vectors(rows)
    assert embed_dedup.group_vectors(table.filter("vec_id < 0")).collect() == []


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(8)
    x = embed_dedup.unit((rng.normal(size=64) + rng.normal(size=(400, 64))).tolist())
    signs, factor = embed_dedup.code(x)
    rotated = x @ embed_dedup.rotation(64)[:, :64]
    estimate = signs @ rotated.T / 8 / factor[:, None]
    true = x @ x.T
    off = ~np.eye(len(x), dtype=bool)
    assert abs((estimate - true)[off].mean()) < 0.01
    assert (embed_dedup.upper_bound(signs, factor, rotated) >= true)[off].mean() > 0.99


def test_tables_follow_from_the_number_of_vectors():
    """Of random pairs at cosine 0.9, over nine tenths share a table, however many signs a table has."""
    rng = np.random.default_rng(21)
    x = embed_dedup.unit(rng.normal(size=(1500, 64)).tolist())
    y = rng.normal(size=x.shape)
    y = embed_dedup.unit((y - (x * y).sum(1, keepdims=True) * x).tolist())
    y = 0.9 * x + np.sqrt(1 - 0.81) * y
    assert embed_dedup.plan_tables(50_000) == (20, 64) and embed_dedup.plan_tables(10**8)[0] == 31
    for count in (1000, 200_000):
        plan = embed_dedup.plan_tables(count)
        met = (embed_dedup.table_keys(x, *plan) == embed_dedup.table_keys(y, *plan)).any(1).mean()
        assert met > 0.9
