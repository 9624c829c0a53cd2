"""Spelling variants, conversation repair and URL filters against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reportstar.llm import conversation, spelling, url_filter
from reportstar.staging import stage

# --- spelling variants


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_variants(rows, damage):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    form, near = {}, {}
    for w, n in words.items():
        near[w] = [x for x in words if one_apart(w, x)]
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted(((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=repr)


def make_words(rng, syllables, n):
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(2, 4))) for _ in range(n)]


@pytest.mark.parametrize("damage", [None, 7])
def test_spelling_variants(spark, damage):
    rng = random.Random(3)
    pool = make_words(rng, ["on", "ti", "Th", "èr", "er", "re", "ÿ", "÷a", "no"], 120)
    pool += ["aaaaaaa", "aaaaaa", "aaaaab", "baaaaa", "a" * 3000, "a" * 2999 + "b", "abcabc", "acbabc", "Àbcabc", "àbcabc", "ßbcabc"]
    weights = [rng.choice([1, 1, 6, 40, 300]) for _ in pool]
    rows = []
    for i in range(260):
        picked = rng.choices(pool, weights, k=25)
        for k in range(len(picked)):
            if rng.random() < 0.05 and len(picked[k]) > 6:
                at = rng.randrange(len(picked[k]))
                picked[k] = picked[k][:at] + rng.choice(["", "z", "e"]) + picked[k][at + 1 :]
        rows.append((i if i % 11 else None, rng.choice([" ", ", ", "9", "\n"]).join(picked)))
    rows += [(1, None), (2, ""), (3, "short"), rows[5], rows[5]]
    rows += [(400 + i, "rooting " * 10 + "rootink " * (i < 30) + "rootank" * (i < 5)) for i in range(40)]
    table = stage(spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int"), "variants")
    found = spelling.group_variants(table, damage=damage)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(rows, damage)
    assert any(w[1] != w[2] for w in want if w[1])  # a form that has a form itself
    assert sorted((tuple(r) for r in found.collect()), key=repr) == want


def test_spelling_variants_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.group_variants(empty).collect() == []
    none = spark.createDataFrame([(1, None), (2, "words of no account")], "doc_id long, text string")
    assert spelling.group_variants(none).collect() == []
    one = spark.createDataFrame([("x", "lonely " * 5)], "doc_id string, text string")
    assert [tuple(r) for r in spelling.group_variants(one).collect()] == [("lonely", None, "lonely", 5, 0, None)]


def test_classes_within_distance_two_share_a_signature():
    rng = random.Random(5)
    base = ["".join(sorted(rng.choices("abcdeé", k=rng.randint(1, 14)))) for _ in range(200)]
    other = []
    for w in base:
        letters = list(w)
        for _ in range(rng.randint(0, 2)):
            if letters and rng.random() < 0.5:
                letters.pop(rng.randrange(len(letters)))
            else:
                letters.append(rng.choice("abcdefé"))
        other.append("".join(sorted(letters)) or "a")
    parts = [spelling.vectors(pa.array(x)) for x in (base, other)]
    sig = [spelling.signatures(p[0]) for p in parts]
    for k, (a, b) in enumerate(zip(base, other, strict=True)):
        x, y = Counter(a), Counter(b)
        far = sum(((x - y) + (y - x)).values())
        assert far > 2 or (sig[0][k] == sig[1][k]).any()
        assert (parts[0][1][k] ^ parts[1][1][k]).item().bit_count() <= far
    assert spelling.letter_classes(pa.array(["banana", "éa"])).to_pylist() == ["aaabnn", "aé"]


# --- conversations

GRAMMAR = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
GIVEN = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}


def brute_repair(rows):
    """Report of one conversation's rows ``(turn, role, text)`` in order, by a search over all edits."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.rstrip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)

    @lru_cache(None)
    def best(i, q, inserted=0):
        ways = [(0, "", ())] if i == len(rows) and q in (0, 3) else []
        role, after = GIVEN[q]
        if inserted < 2:
            c, a, t = best(i, after, inserted + 1)
            ways.append((c + 2, "I" + a, ((role, ""), *t)))
        if i < len(rows):
            c, a, t = best(i + 1, q)
            ways.append((c + 3, "D" + a, t))
            if faults[i] not in ("blank", "duplicate"):
                late = int(faults[i] == "truncated")
                c, a, t = best(i + 1, after)
                ways.append((c + 2 + late, "R" + a, ((role, rows[i][2]), *t)))
                kept = q if rows[i][1] == "" else GRAMMAR[q].get(rows[i][1][0])
                if kept is not None:
                    c, a, t = best(i + 1, kept)
                    ways.append((c + late, "K" + a, (rows[i][1:], *t)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, turns = best(0, 0)
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    said = "\n".join(f"{r}:{t}" for r, t in turns)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(said.encode()).hexdigest()), turns


def brute_damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        conv_text, turn_text, role, text = (" " if x is None else str(x) for x in (conv, turn, role, text))
        way = zlib.crc32(f"{conv_text}:{turn_text}".encode()) % 20
        mine = out.setdefault(conv, [])
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        mine += [] if way == 0 else [(turn, "user" if way == 4 else role, text)] * (2 if way == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0)) for c, r in out.items()}


def talks(rng):
    texts = ["Yes.", "No!", "Why?", "and then", "", " \n", "x.", None, "tail. \t", "ends "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "u"]
    rows = []
    for conv in [*range(70), None]:
        plain = rng.random() < 0.4
        for turn in range(rng.randint(1, 9)):
            role = ["user", "assistant"][turn % 2] if plain else rng.choice(roles)
            text = f"Turn {turn}." if plain and rng.random() < 0.8 else rng.choice(texts)
            rows.append((conv, None if rng.random() < 0.08 else turn - rng.randint(0, 1) * 3, role, text))
    for turn in range(150):
        rows.append((900, turn, rng.choice(roles), f"{turn}." if rng.random() < 0.7 else rng.choice(texts)))
    return rows


@pytest.mark.parametrize("long_rows,long_bytes", [(20_000, 1 << 25), (4, 1 << 25), (4, 0)])
def test_conversation_repair(spark, long_rows, long_bytes):
    rows = talks(random.Random(11))
    kind = "conv_id long, turn long, role string, text string, live string, pos int"
    table = stage(spark.createDataFrame([(*r, "x", 1) for r in rows], kind).coalesce(1), "talks")
    damaged = conversation.damage(table)
    got = conversation.repair(damaged, live="live", place="place", long_rows=long_rows, long_bytes=long_bytes)
    want = {c: brute_repair(r) for c, r in brute_damage(rows).items()}
    found = {r.conv_id: tuple(r)[1:] for r in got.reports.collect()}
    assert found == {c: w[0] for c, w in want.items()}
    turns = {}
    for r in sorted(got.turns.collect(), key=lambda r: (r.conv_id or -1, r.n)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {c: list(w[1]) for c, w in want.items() if w[1]}


def test_conversation_repair_of_few(spark):
    kind = "conv_id string, turn int, role string, text string"
    assert conversation.repair(spark.createDataFrame([], kind)).reports.collect() == []
    dead = spark.createDataFrame([("a", 0, "user", "x.", False), ("b", 1, "user", "x.", None)], kind + ", live boolean")
    empty = hashlib.sha256(b"").hexdigest()
    for long_rows in (9, 0):
        got = conversation.repair(dead, live="live", long_rows=long_rows).reports.collect()
        assert sorted(tuple(r) for r in got) == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c in "ab"]
    long = spark.createDataFrame([("a", 0, "user", "word " * 200_000)], kind)
    report = conversation.repair(long).reports.first()
    assert (report.truncated, report.cost, report.audit) == (1, 3, "D")


def test_ranks_order_whole_audits():
    rng = np.random.default_rng(2)
    size = rng.integers(0, 40, 60)
    bounds = np.concatenate([[0], np.cumsum(size)])
    n = int(bounds[-1])
    ways = conversation.Costs(rng.integers(0, 5, n), rng.random(n) < 0.2, rng.random(n) < 0.2, bounds, np.tile(conversation.FINISH, (60, 1)), np.ones(60, bool))
    ways.rank_paths()
    for node in range(len(ways.next)):
        at, cost = node, 0
        for _ in range(200):
            arcs = {int(x): int(t) for x, t in zip(ways.letters[at], ways.targets[at], strict=True) if x}
            assert bool(arcs) == bool(ways.edit[at])
            if not arcs:
                break
            assert ways.edit[at] == min(arcs) and ways.next[at] == arcs[min(arcs)]
            at, cost = arcs[min(arcs)], cost + 1
        assert cost == ways.length[node] and at % 4 in (0, 3)


# --- URLs


def brute_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for h, p, action in rules:
        if None not in (h, p, action):
            h = re.sub("[A-Z]", lambda m: m[0].lower(), h)
            if (host == h or host.endswith("." + h)) and path.startswith(p):
                fits.append((len(h) + len(p), len(h), action, h + p))
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


RULES = [
    ("com", "/", "allow"), ("Example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "", "block"),
    ("a.net", "/d", "block"), ("net", "/dé", "allow"), ("a.net", "/deep/er/fi", "allow"), ("a.net", "/deep/er/fi", "block"), ("", "/x", "block"),
    ("b.org", "/en", "block"), ("b.org", "/e", "allow"), (None, "/", "block"), ("com", None, "block"), ("com", "/", None), ("com:80", "/", "block"), ("com", "/", "allow"),
]


@pytest.mark.parametrize("max_rows", [500_000, 0])
def test_url_filter(spark, max_rows):
    rng = random.Random(7)
    hosts = ["example.com", "WWW.Example.COM", "x.www.example.com", "myexample.com", "a.net", "b.a.net", "net", "b.org", "", "org.", "com:80", "u@b.org", "é.net"]
    paths = ["", "/", "/en/", "/en", "/english", "/es/1", "/dé/f", "/deep/er/file", "/deep/er/fi", "/x://com/", "//", "/d" * 3000]
    urls = [f"{s}{h}{p}{q}" for s in ("http://", "://", "") for h in hosts for p in paths for q in rng.sample(["", "?a/b#c", "#/en/?x", "?", "\n"], 2)]
    urls += [None, "", "no url", "http:/a.net/d", "a://b://a.net/d"] + urls[:9]
    rows = [(i, u, "h", 1) for i, u in enumerate(urls)]
    table = stage(spark.createDataFrame(rows, "page_id long, url string, Host string, url_row int"), "urls")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = url_filter.judge(table, rules, max_rows=max_rows)
    assert got.columns == ["page_id", "url", "url_row", "host", "path", "rule", "verdict"]
    want = {i: (u, 1, *brute_judge(u, RULES)) for i, u, _, _ in rows}
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want
    assert url_filter.judge(table.limit(0), rules).collect() == []
    free = url_filter.judge(table, rules.limit(0)).groupBy("rule", "verdict").count().collect()
    assert [tuple(r) for r in free] == [(None, "allow", len(rows))]


def test_rules_of_one_folder_keep_few_shapes(spark):
    rules = spark.range(500).select(F.lit("wiki.org").alias("host"), F.concat(F.lit("/wiki/page"), F.col("id").cast("string")).alias("path"), F.lit("block").alias("action"))
    assert url_filter.prepare_rules(rules).select("shape").distinct().count() == 1
    pages = stage(spark.createDataFrame([(1, "http://wiki.org/wiki/page7"), (2, "http://wiki.org/wiki/pag")], "page_id long, url string"), "wiki")
    assert sorted((r.page_id, r.rule) for r in url_filter.judge(pages, rules).collect()) == [(1, "wiki.org/wiki/page7"), (2, None)]
