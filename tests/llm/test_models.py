"""Trained operators: accuracy on what was held out, edge cases, and the mathematics of the networks."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportstar.llm import html_text, langid, quality
from reportstar.staging import stage

DOCS = "doc_id long, text string, lang string, quality_score string"


def prose(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(6)
    alphabets = {"aa": "abcdefé", "bb": "opqrstü", "cc": "ghijklñ"}
    rows, labels = [], []
    for i in range(400):
        lang = rng.choice(list(alphabets))
        text = prose(rng, alphabets[lang], rng.randint(20, 80))
        good = rng.random() > 0.25
        if not good:
            text = " ".join(w + rng.choice(("***", "%%%")) for w in text.split(" "))
        rows.append((i, text.upper() if i % 11 == 0 else text, lang if i % 3 else None, "x"))
        labels.append((i, int(good), 0))
    rows += [(900, None, "aa", "x"), (901, "", "bb", "x"), (902, " 12 ?! ", None, "x"), (None, rows[0][1], "aa", "x"), (3, *rows[3][1:]), (903, "abc " * 60_000, "aa", "x")]
    labels += [(900, 1, 0), (901, None, None), (None, 1, 0), (5000, 0, 0), (3, labels[3][1], 0)]
    truth = {i: next(k for k, a in alphabets.items() if set(t.lower()) & set(a)) for i, t, _, _ in rows[:400]}
    return rows, labels, truth


def tables(spark, rows, labels=()):
    return stage(spark.createDataFrame(rows, DOCS), "docs"), spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")


def test_quality(spark, corpus):
    rows, labels, _ = corpus
    docs, marked = tables(spark, rows, labels)
    model = quality.fit_quality(docs, marked)
    scored = quality.score_quality(docs, model, "score").select("*", quality.held_out(F.col("doc_id")).alias("out")).collect()
    assert len(scored) == len(rows) and all(0 <= r.score <= 1 for r in scored)
    apart = [r for r in scored if r.out and r.doc_id < 400]
    right = [(r.score >= 0.5) == bool(labels[r.doc_id][1]) for r in apart]
    assert len(apart) > 80 and np.mean(right) > 0.95
    assert len({r.score for r in scored if r.text is None or r.text == ""}) == 1
    assert len({r.score for r in scored if r.doc_id == 3}) == 1
    kept = quality.keep_good(docs, marked)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score >= 0.5 for r in scored)


def test_quality_without_lessons(spark, corpus):
    docs, none = tables(spark, corpus[0][:20])
    score = lambda labels: {r.score for r in quality.score_quality(docs, quality.fit_quality(docs, labels), "score").collect()}
    assert score(none) == {0.5}
    assert score(spark.createDataFrame([(i, 1, 0) for i in range(20)], none.schema)) == {1.0}
    empty, _ = tables(spark, [])
    assert quality.keep_good(empty, none).collect() == []


def test_labels_that_are_held_out_teach_nothing(spark, corpus):
    rows, labels, _ = corpus
    docs, marked = tables(spark, rows, labels)
    out = {r.doc_id for r in docs.filter(quality.held_out(docs["doc_id"])).collect()}
    flipped = [(i, q if i not in out or q is None else 1 - q, t) for i, q, t in labels]
    score = lambda m: sorted((r.doc_id or -1, r.score) for r in quality.score_quality(docs, quality.fit_quality(docs, m), "score").collect())
    assert score(marked) == score(tables(spark, rows, flipped)[1])


def test_languages(spark, corpus):
    rows, _, truth = corpus
    docs, _ = tables(spark, rows)
    found = langid.identify(docs, langid.fit_languages(docs), "found").select("doc_id", "text", "found.*", langid.held_out(F.col("doc_id")).alias("out")).collect()
    apart = [r.lang == truth[r.doc_id] for r in found if r.out and r.doc_id < 400]
    assert len(apart) > 40 and np.mean(apart) > 0.98
    assert all((r.lang, r.score) == ("und", 0) for r in found if r.doc_id in (900, 901, 902))
    assert all(0 < r.score <= 1 for r in found if r.lang != "und")
    assert len(found) == len(rows)
    plain = docs.drop("lang").withColumn("lang", docs["text"].substr(1, 0))  # one language only
    assert {r.f.lang for r in langid.identify(plain, langid.fit_languages(plain), "f").collect()} == {"", "und"}
    unknown = docs.filter("lang is null")
    assert {r.f.lang for r in langid.identify(unknown, langid.fit_languages(unknown), "f").collect()} == {"und"}


def test_presence_is_the_set_of_grams():
    texts = ["Abc abÉ", "", "a", "abcabcabc"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    together = langid.presence(data, bounds)
    for i, t in enumerate(texts):
        own = np.frombuffer(t.encode(), np.uint8)
        alone = langid.presence(own, np.array([0, len(own)]))
        assert (together[i] == alone[0]).all()
    lower = np.frombuffer(b"abc ab\xc3\xa9", np.uint8)
    assert (together[0] == langid.presence(lower, np.array([0, len(lower)]))[0]).all()


def test_gradients_of_the_block_labeller():
    rng = np.random.default_rng(0)
    net = html_text.Labeller()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = rng.normal(size=(5, 3, html_text.PATH + html_text.WORD + html_text.COUNTS)) * 0.3
    mask = np.ones((5, 3))
    mask[3:, 1] = mask[1:, 2] = 0
    y = (rng.random((5, 3)) > 0.5).astype(float)

    def loss():
        p = net.probability(x, mask)
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    grad = net.gradients(x, mask, y)
    for k, w in net.w.items():
        flat, at = w.reshape(-1), rng.integers(w.size)
        old, step = flat[at], 1e-3
        flat[at] = old + step
        up = loss()
        flat[at] = old - step
        down = loss()
        flat[at] = old
        assert abs((up - down) / 2 / step - np.asarray(grad[k]).reshape(-1)[at]) < 1e-4, k


def test_blocks():
    page = '<body><nav><a href="/">Home</a></nav><p>One <b>two<br>x</b>&amp; three<p>Four</div><ul><li>a<li>b</ul><!-- c --><script>var t="</p>";</script>tail &lt;i&gt;<td title="a>b">cell'
    assert [b.text for b in html_text.blocks(page)] == ["Home", "One two x& three", "Four", "a", "b", "tail <i>", "cell"]
    assert html_text.blocks(None) == html_text.blocks("") == html_text.blocks("<p> </p>") == []
    assert [b.text for b in html_text.blocks("a < b <p unclosed")] == ["a < b <p unclosed"]


def page(rng, start, end, parts=("", "")):
    body = [prose(rng, "abcdefghi", rng.randint(4, 40)) for _ in range(rng.randint(2, 6))]
    menu = "".join(f'<li><a href="/{k}">{prose(rng, "abcd", 1)}</a></li>' for k in range(4))
    before, after = parts
    text = "".join(f"<p>{b}</p>" for b in body)
    return (f"<html><head><title>t</title><style>p{{}}</style></head><body><nav><ul>{menu}</ul></nav>{before}{start}<h1>{body[0][:20].strip()}</h1>{text}{end}{after}<footer>&copy; {prose(rng, 'abc', 3)}</footer></body></html>",
            "\n\n".join([body[0][:20].strip(), *body]))


def test_html_text(spark):
    rng = random.Random(12)
    known = [page(rng, "<article>", "</article>", ('<div class="ad">buy this</div>', "")) for _ in range(60)]
    rows = [(i, "u", h, "x") for i, (h, _) in enumerate(known)]
    other = [
        page(rng, '<main><div class="content">', "</div></main>", ('<aside class="sidebar"><p>More of the same text here.</p></aside>', '<div class="comments"><p>I like it, said a reader.</p></div>')),
        page(rng, "<article>", "</article>", ('<div class="cookie notice"><p>We use cookies, you know.</p></div><header><p>Site name</p></header>', '<form action="/"><label>Mail</label><p>Sign up now.</p></form>')),
        page(rng, "<article>", "</article>", ("", '<section id="comments"><div class="comment"><p>First, of course.</p></div></section>')),
    ]
    rows += [(100 + i, "u", h, "x") for i, (h, _) in enumerate(other)] + [(200, None, None, "x"), (201, "u", "", "x"), (202, "u", "plain", "x"), (0, *rows[0][1:]), (None, "u", rows[1][2], None)]
    pages = stage(spark.createDataFrame(rows, "page_id long, url string, html string, text_ string"), "pages")
    found = html_text.extract(pages, html_text.fit_labeller(pages), "text").collect()
    assert len(found) == len(rows)
    text = {r.page_id: r.text for r in found if r.page_id is not None}
    assert all(text[i] == t for i, (_, t) in enumerate(known))
    assert sum(text[100 + i] == t for i, (_, t) in enumerate(other)) >= 2
    assert text[200] == text[201] == ""
    empty = pages.filter("page_id < 0")
    assert html_text.extract(empty, html_text.fit_labeller(empty), "text").collect() == []
