"""Main text of web pages by a bidirectional recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, each with the path of its open
elements. A block is described by its hashed path (tags, words of class, id and role), its hashed words and
a few counts. A bidirectional LSTM in numpy reads the blocks of a page in both directions, so that every
block is classified with the whole page as context. Blocks it takes for the article make up the text.

The network is trained here on a bounded sample of the pages: each is used as it is and in variants whose
containers are renamed and into which menus, side columns, notices, adverts, forms and reader
comments are set, filled with text of other sampled pages. Labels of the sample come from the meaning of
element names and of class and id words; the network learns from paths, words and neighbours together.

Comments, scripts, styles and other unseen content are no blocks. Null and empty pages have an empty text,
as have pages without article blocks. An unclosed tag or element ends with the page. Nothing is capped:
a page of any length is read whole. Repeated pages are extracted each; other columns pass through.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportstar.llm.common import append_column

PATH, WORD, COUNTS, HIDDEN = 256, 64, 8, 16
#: Bound of the sample that is learnt from, in pages and in characters of a page.
SAMPLE, SAMPLE_CHARS = 240, 100_000
STEPS, BATCH, LENGTH = 420, 32, 40

UNSEEN = re.compile(r"<!--.*?(?:-->|$)|<(script|style|noscript|template|svg|iframe|object|select|textarea|title)\b[^>]*>.*?(?:</\1\s*>|$)", re.S | re.I)
TAG = re.compile(r"""<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<[!?/][^>]*>""")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
HOLDS = frozenset("ul ol dl table div section article main aside nav header footer form body blockquote figure".split())

# Words of names that set a part of a page apart from its article.
APART_TAGS = frozenset("nav header footer aside form menu dialog button label fieldset legend".split())
APART_WORDS = frozenset("ad ads advert advertisement adverts sponsor sponsored promo banner sidebar menu nav navbar navigation breadcrumb breadcrumbs header masthead footer copyright cookie cookies consent notice alert popup modal newsletter subscribe signup login share social related recommended comment comments reply replies discussion widget toolbar pager pagination search form".split())
ARTICLE_TAGS = frozenset(["article", "main"])
ARTICLE_WORDS = frozenset("article content main post entry story body text".split())


@dataclass
class Block:
    text: str
    path: tuple[str, ...]
    linked: float


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order; an element that opens inside an open paragraph closes it."""
    page = UNSEEN.sub(" ", page or "")
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = in_link = at = 0

    def close() -> None:
        nonlocal linked
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                out.append(Block(text, tuple(x for _, names in stack for x in names), min(linked / len(text), 1.0)))
            parts.clear()
        linked = 0

    for tag in TAG.finditer(page):
        if tag.start() > at:
            parts.append(page[at : tag.start()])
            linked += in_link * (tag.start() - at)
        at = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if name in INLINE:
            in_link = int(not tag[1]) if name == "a" else in_link
            if name in ("br", "img", "wbr"):
                parts.append(" ")
            continue
        close()
        in_link = 0
        if tag[1]:
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
            continue
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in CLOSES.get(name, ()) or stack[k][0] == "p":
                del stack[k:]
                break
            if stack[k][0] in HOLDS:
                break
        if name not in VOID and not tag[3].endswith("/"):
            words = re.findall(r"[a-z]+", " ".join(NAMED.findall(tag[3])).lower()) if "=" in tag[3] else ()
            stack.append((name, (name, *(f".{w}" for w in words))))
    if at < len(page):
        parts.append(page[at:])
    close()
    return out


_words: dict[str, tuple[int, float]] = {}
_paths: dict[tuple[str, ...], np.ndarray] = {}


def _word(w: str) -> tuple[int, float]:
    h = crc32(w.encode("utf-8", "surrogatepass"))
    if len(_words) > 200_000:
        _words.clear()
    found = _words[w] = (h % WORD, 1.0 if h >> 31 else -1.0)
    return found


def _path(path: tuple[str, ...]) -> np.ndarray:
    if len(_paths) > 20_000:
        _paths.clear()
    row = _paths[path] = np.zeros(PATH, np.float32)
    row[[crc32(x.encode()) % PATH for x in path]] = 1
    return row


def describe(page: list[Block]) -> np.ndarray:
    """One row per block: path, words, counts."""
    x = np.zeros((len(page), PATH + WORD + COUNTS), np.float32)
    for i, b in enumerate(page):
        known = _paths.get(b.path)
        x[i, :PATH] = _path(b.path) if known is None else known
        words = b.text.split(" ")
        hashed = [_words.get(w) or _word(w) for w in words]
        at, sign = zip(*hashed, strict=True)
        hashed = np.bincount(at, sign, WORD)
        x[i, PATH : PATH + WORD] = hashed / max(np.sqrt(hashed @ hashed), 1)  # a text that repeats a word is no outlier
        stops = b.text.count(".") + b.text.count(",")
        x[i, PATH + WORD :] = (np.log1p(len(words)) / 4, np.log1p(len(b.text)) / 6, b.linked, min(stops / len(words), 1),
                               i / len(page), (len(page) - 1 - i) / len(page), len(b.path) / 8, 1)
    return x


def meant(block: Block) -> int:
    """Label of a sampled block from the names on its path."""
    apart = any(x in APART_TAGS or x[1:] in APART_WORDS and x[0] == "." for x in block.path)
    inside = any(x in ARTICLE_TAGS or x[1:] in ARTICLE_WORDS and x[0] == "." for x in block.path)
    return int(inside and not apart)


def variants(pages: list[str], rng: random.Random) -> list[str]:
    """Each page as it is and with other containers and parts set around and into its article."""
    texts = [b.text for p in pages for b in blocks(p)] or ["text"]
    some = lambda n: " ".join(rng.choice(texts) for _ in range(n))[: rng.choice((30, 120, 400))].replace("<", " ")
    apart = [
        '<aside class="sidebar"><h3>{}</h3><ul><li><a href="#">{}</a></li><li><a href="#">{}</a></li></ul></aside>',
        '<div class="notice cookie-consent"><p>{}</p><p>{}</p></div>', '<div id="comments" class="comments"><h2>{}</h2><div class="comment"><p>{}</p></div><div class="comment"><p>{}</p></div></div>',
        '<section class="reader-comments"><p>{}</p><p>{}</p></section>', '<div class="advert"><p>{}</p></div>', '<div class="ad">{}</div>', '<form action="#"><label>{}</label><p>{}</p></form>',
        '<header><h1>{}</h1><p>{}</p></header>', '<header class="site-header"><div>{}</div></header>', '<div class="menu"><ul><li>{}</li><li>{}</li></ul></div>', '<div class="related"><h3>{}</h3><p>{}</p></div>',
        '<div class="newsletter signup"><p>{}</p></div>', '<div role="navigation"><a>{}</a><a>{}</a></div>', '<div class="share">{}</div>', '<div class="banner">{}</div>', '<footer><p>{}</p><p>{}</p></footer>',
    ]
    holders = [("<article>", "</article>"), ('<article class="post">', "</article>"), ("<main>", "</main>"), ('<main><div class="content">', "</div></main>"), ('<div id="content">', "</div>"), ('<div class="article-body">', "</div>"), ('<div class="entry-content">', "</div>"), ("<main><article>", "</article></main>")]
    out = list(pages)
    for _ in range(2):
        for page in pages:
            start, end = rng.choice(holders)
            piece = lambda: re.sub(r"\{\}", lambda _: some(rng.choice((1, 1, 3))), rng.choice(apart))
            before, after = ("".join(piece() for _ in range(rng.choice((0, 1, 2)))) for _ in range(2))
            inside = piece() if rng.random() < 0.4 else ""
            extra = "".join(rng.choice(("<h2>{}</h2>", "<p>{}</p>", "<blockquote><p>{}</p></blockquote>", "<ul><li>{}</li></ul>")).replace("{}", some(1)) for _ in range(rng.choice((0, 0, 2))))
            page = re.sub(r"<article[^>]*>", lambda _: before + start, page, count=1)  # noqa: B023
            page = page.replace("</article>", extra + inside + end + after, 1)
            out.append(page)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """LSTM layers for both directions and a logistic output for every block."""

    def __init__(self, seed: int = 3):
        rng, width = np.random.default_rng(seed), PATH + WORD + COUNTS
        small = lambda *s: rng.normal(0, s[0] ** -0.5, s).astype(np.float32)
        self.w = {"out": small(2 * HIDDEN, 1)[:, 0], "bias": np.zeros(1, np.float32)}
        for d in "fb":
            bias = np.zeros(4 * HIDDEN, np.float32)
            bias[HIDDEN : 2 * HIDDEN] = 1
            self.w |= {f"x{d}": small(width, 4 * HIDDEN), f"h{d}": small(HIDDEN, 4 * HIDDEN), f"b{d}": bias}

    def layer(self, x: np.ndarray, mask: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States of one direction for ``(time, page, feature)``; masked steps keep the state."""
        steps, pages, _ = x.shape
        pre = x @ self.w[f"x{d}"] + self.w[f"b{d}"]
        h = c = np.zeros((pages, HIDDEN), np.float32)
        out = np.zeros((steps, pages, HIDDEN), np.float32)
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            z = pre[t] + h @ self.w[f"h{d}"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new = f * c + i * g
            s = np.tanh(new)
            if keep is not None:
                keep.append((t, h, c, i, f, o, g, s, m))
            c = m * new + (1 - m) * c
            h = m * (o * s) + (1 - m) * h
            out[t] = h
        return out

    def probability(self, x: np.ndarray, mask: np.ndarray) -> np.ndarray:
        both = np.concatenate([self.layer(x, mask, d) for d in "fb"], axis=2)
        return _sigmoid(both @ self.w["out"] + self.w["bias"])

    def gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean logistic loss, by backpropagation through time."""
        trace: dict[str, list] = {"f": [], "b": []}
        both = np.concatenate([self.layer(x, mask, d, trace[d]) for d in "fb"], axis=2)
        error = (_sigmoid(both @ self.w["out"] + self.w["bias"]) - y) * mask / mask.sum()
        grad = {"out": np.einsum("tph,tp->h", both, error), "bias": error.sum(keepdims=True)[0]}
        back = error[:, :, None] * self.w["out"]
        for k, d in enumerate("fb"):
            dh = dc = np.zeros((x.shape[1], HIDDEN), np.float32)
            wide = np.zeros((*x.shape[:2], 4 * HIDDEN), np.float32)
            grad[f"h{d}"] = np.zeros_like(self.w[f"h{d}"])
            for t, h, c, i, f, o, g, s, m in reversed(trace[d]):
                dh = dh + back[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                a, e = m * dh, m * dc
                e = e + a * o * (1 - s**2)
                z = np.hstack([e * g * i * (1 - i), e * c * f * (1 - f), a * s * o * (1 - o), e * i * (1 - g**2)])
                wide[t] = z
                grad[f"h{d}"] += h.T @ z
                dh = (1 - m) * dh + z @ self.w[f"h{d}"].T
                dc = (1 - m) * dc + e * f
            grad[f"x{d}"] = np.einsum("tpi,tpj->ij", x, wide, optimize=True)
            grad[f"b{d}"] = wide.sum((0, 1))
        return grad

    def fit(self, pages: list[tuple[np.ndarray, np.ndarray]], seed: int = 5) -> None:
        """Adam on pieces of ``LENGTH`` blocks; words are hidden at random, so that paths count too."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, STEPS + 1):
            x = np.zeros((LENGTH, BATCH, PATH + WORD + COUNTS), np.float32)
            y, mask = np.zeros((LENGTH, BATCH), np.float32), np.zeros((LENGTH, BATCH), np.float32)
            for j, k in enumerate(rng.integers(0, len(pages), BATCH)):
                px, py = pages[k]
                at = rng.integers(0, max(len(px) - LENGTH, 0) + 1)
                n = min(LENGTH, len(px))
                x[:n, j], y[:n, j], mask[:n, j] = px[at : at + n], py[at : at + n], 1
            if step % 2:
                x[:, :, PATH : PATH + WORD] = 0
            rate = 0.01 * (1 - step / (STEPS + 1))
            for k, g in self.gradients(x, mask, y).items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                self.w[k] = (self.w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-7)).astype(np.float32)

    def label(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """Which blocks of each page belong to its article; pages of like length go together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
        first = 0
        while first < len(order):
            last = first + 1
            while last < len(order) and last - first < 64 and (last - first + 1) * len(pages[order[last]]) <= 20_000:
                last += 1
            own = order[first:last]
            steps = len(pages[own[-1]])
            x, mask = np.zeros((steps, len(own), PATH + WORD + COUNTS), np.float32), np.zeros((steps, len(own)), np.float32)
            for j, k in enumerate(own):
                n = len(pages[k])
                x[:n, j], mask[:n, j] = describe(pages[k]), 1
            p = self.probability(x, mask)
            for j, k in enumerate(own):
                out[k] = p[: len(pages[k]), j] >= 0.5
            first = last
        return out


def fit_labeller(pages: DataFrame, sample: int = SAMPLE) -> Labeller:
    """Train on at most ``sample`` pages of at most ``SAMPLE_CHARS`` characters, those of the smallest hashes."""
    short = pages.select("html", F.xxhash64("html").alias("h")).filter(F.length("html").between(1, SAMPLE_CHARS))
    ids = [r.h for r in short.select("h").distinct().orderBy("h").limit(sample).collect()]
    htmls = sorted({r.html for r in short.filter(F.col("h").isin(ids)).dropDuplicates(["h"]).collect()}) if ids else []
    net = Labeller()
    taught = [(describe(b), np.array([meant(x) for x in b], np.float32)) for p in variants(htmls, random.Random(11)) if (b := blocks(p))]
    if taught:
        net.fit(taught)
    return net


def extract(pages: DataFrame, net: Labeller, name: str) -> DataFrame:
    """Add column ``name``, the article blocks of ``html`` joined by blank lines."""

    def values(column: pa.Array) -> pa.Array:
        texts: list[str] = []
        for at in range(0, len(column), 128):
            cut = [blocks(p) for p in column.slice(at, 128).to_pylist()]
            for page, keep in zip(cut, net.label(cut), strict=True):
                texts.append("\n\n".join(b.text for b, k in zip(page, keep, strict=True) if k))
        return pa.array(texts, pa.string())

    return append_column(pages, "html", name, T.StringType(), values)
