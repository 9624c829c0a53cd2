"""Mixing, license scans, the pipeline and the registered SQL against brute force."""

import hashlib
import math
import random
import re
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from check_oracle import compare, connect
from reportstar.llm import decontaminate, licenses, mixing, quality
from reportstar.llm.queries import ORACLE, QUERIES
from reportstar.staging import new_path, stage
from test_exact import words
from test_near_copies import brute_keep
from test_whole_runs import brute_maximal

SMOKE = "/root/testdata/sf0.001"


def copies(rows, weights, default, seed=mixing.SEED):
    """``rows`` of (doc_id, source): number of copies of each."""
    sizes = Counter(s for _, s in rows)
    total = sum(weights.get(s, default) for s in sizes)
    out = []
    for doc_id, s in rows:
        rate = weights.get(s, default) / total * len(rows) / sizes[s]
        digest = hashlib.md5(f"{seed}|{'' if doc_id is None else doc_id}".encode()).hexdigest()
        u, n, at = int(digest[:13], 16) / 2**52, 0, math.exp(-rate)
        while rate > 0 and u >= at:
            n += 1
            at += math.exp(n * math.log(rate) - rate - math.lgamma(n + 1))
        out.append(n)
    return out


@pytest.mark.parametrize("weights", [{}, {"a": 0.7, "c": 0.0}])
def test_mixing(spark, weights):
    rows = [(i, "aab"[i % 3] if i % 10 else None) for i in range(3000)] + [(5000 + i, "c") for i in range(50)] + [(None, "a"), (1, "a"), (1, "a")]
    docs = stage(spark.createDataFrame([(*r, "t", "x") for r in rows], "doc_id long, source string, text string, mix_cdf string"), "docs")
    found = mixing.mix_sources(docs, weights, 0.1)
    assert found.columns == docs.columns
    got = Counter((r.doc_id, r.source) for r in found.collect())
    want = Counter()
    for r, n in zip(rows, copies(rows, weights, 0.1), strict=True):
        want[r] += n
    assert got == +want
    numbered = [r.k for r in mixing.mix_sources(docs, weights, 0.1, key_name="k").collect()]
    assert numbered == sorted(numbered)
    assert mixing.mix_sources(docs.limit(0)).collect() == []


def test_high_rates(spark):
    docs = stage(spark.createDataFrame([(i, "a" if i else "b") for i in range(2000)], "doc_id long, source string"), "docs")
    rare = spark.range(200_000).selectExpr("id as doc_id", "if(id = 7, 'rare', 'common') as source")
    n = mixing.mix_sources(stage(rare, "rare"), {}, 0.1).filter("source = 'rare'").count()
    assert abs(n - 100_000) < 5 * 100_000**0.5
    assert mixing.mix_sources(docs, {"b": 0.9}, 0.1).filter("source = 'b'").count() == copies([(i, "a" if i else "b") for i in range(2000)], {"b": 0.9}, 0.1)[0]


def brute_licenses(rows, templates):
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = lambda w: [" ".join(w[i : i + 5]) for i in range(len(w) - 4)]
    out = set()
    for i, text in rows:
        g = grams(split(text))
        for name, notice in templates.items():
            t = grams(split(notice))
            size = max(4, 1 << (len(t) - 1).bit_length())
            best = max(((len(set(g[k : k + 2 * size]) & set(t)) / len(set(t)), -k) for k in range(0, len(g), size)), default=(0, 0))
            if best[0] >= 0.8:
                out.add((i, name, best[0], -best[1]))
    return out


def test_licenses(spark):
    rng = random.Random(4)
    rows = []
    for i in range(60):
        notice = list(licenses.LONG_TEMPLATES.values())[i % 10].split(" ")
        for _ in range(rng.randint(0, 3) if len(notice) > 20 else 0):
            notice[rng.randrange(len(notice))] = "changed"
        rows.append((i, f"{words(rng, rng.randint(0, 60))}\n{' '.join(notice).upper() if i % 4 == 0 else ' '.join(notice)} {words(rng, rng.randint(0, 30))}"))
    rows += [(100, None), (101, ""), (102, "Licensed under CC"), (103, words(rng, 300)), (104, "released under the mit license " * 300)]
    docs = stage(spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string"), "docs")
    got = {tuple(r) for r in licenses.scan_licenses(docs, licenses.LONG_TEMPLATES).collect()}
    assert got == brute_licenses(rows, licenses.LONG_TEMPLATES) and len({g[1] for g in got}) == 10
    assert licenses.scan_licenses(docs.limit(0)).collect() == []
    twice = stage(docs.filter("doc_id = 2").union(docs.filter("doc_id = 2")), "twice")
    assert licenses.scan_licenses(twice).count() == 2
    with pytest.raises(ValueError, match="at least"):
        licenses.scan_licenses(docs, {"x": "too short"})


def test_pipeline_against_its_stages_by_hand(spark):
    rng = random.Random(8)
    passage = words(rng, 60)
    bench = [(i, words(rng, 30)) for i in range(3)] + [(9, None)]
    rows = [(i, f"{words(rng, 40)}\n{words(rng, 30)}\n{words(rng, 12)}") for i in range(80)]
    rows += [(100 + i, rows[i][1]) for i in range(20)] + [(130 + i, f"{words(rng, 25)}\n{passage}\n{words(rng, 20)}") for i in range(10)]
    rows += [(150 + i, f"{words(rng, 40)} {bench[i][1]} {words(rng, 40)}") for i in range(3)]
    base = words(rng, 500).split(" ")
    rows += [(160 + i, " ".join([*base[: 50 * i], "changed", *base[50 * i + 1 :]])) for i in range(8)]
    rows += [(200, None), (201, ""), (None, words(rng, 30)), (202, words(rng, 40_000))]
    bad = [(300 + i, " ".join(f"{w}***" for w in words(rng, 60).split(" "))) for i in range(40)]
    full = [(i, t, "en", f"s{k % 3 // 2}", len(t or "")) for k, (i, t) in enumerate(rows + bad)]
    folder = new_path(spark, "tables")
    spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int(i < 300), 0) for i, *_ in full if i is not None], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))

    scored = quality.score_quality(docs, quality.fit_quality(docs, labels), "score").collect()
    state = [(r.doc_id, r.text, r.source) for r in scored if r.score >= 0.5]
    assert {i for i, *_ in state} <= {i for i, *_ in rows} and len(state) >= len(rows) - 4
    kept = Counter(brute_maximal([(i, t) for i, t, _ in state], 8))
    source = {i: s for i, _, s in state}
    ordered = list(kept.elements())
    first = [ordered[k] for k in brute_keep(ordered)]
    index = decontaminate.Passages([b for b in bench if b[1]])
    clean = [(i, t) for (i, t), hits in zip(first, index.search([t for _, t in first]), strict=True) if not hits]
    assert len(clean) < len(first) < len(state)
    n = copies([(i, source[i]) for i, _ in clean], mixing.TARGET, mixing.DEFAULT)
    want = Counter({(i, t, "en", source[i], len(t) if t is not None else None): k for (i, t), k in zip(clean, n, strict=True) if k})
    assert Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).collect()) == want
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "decontamination", "mix"]


@pytest.mark.skipif(not Path(SMOKE).is_dir(), reason="benchmark tables not present")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert name in QUERIES
    assert compare(spark, connect(SMOKE), name, SMOKE) == ""
