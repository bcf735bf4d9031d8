"""Main-text extraction by gradient-boosted trees over DOM nodes, decoded over the hierarchy.

A page becomes a tree of block elements with its text in blocks (runs of inline content). Each element has
features: its tag, depth, place among siblings, text, links, punctuation and tags in its subtree, densities,
tokens of class, id and role, and its parent's. Trees trained by numpy give the probability that an element
holds main text. Decoding picks keep or drop for all elements at once: a dropped element drops everything
below it, a kept one has kept ancestors, and the joint likelihood is the greatest under that rule.

The tables hold no marked pages, so the training labels are weak: rules of high precision on the markup (roles,
tags and tokens of a fixed list), on a bounded sample of pages. Each sampled page also comes in variants, whose
main element has another tag or class and which have further boilerplate (of the page's own sentences) put in.
A quarter of the training rows have their tags and tokens blanked, so that the trees also learn what densities
and places say where the markup is mute.

Defined results: null and empty html give the empty text, as does a page without main text. Unclosed and
stray tags are closed as browsers would for the common cases. Repeated rows and ids are each extracted; an empty
table gives no rows. Other columns pass untouched in ``extract``.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsmill.llm import common

#: Elements of the HTML standard by how they are treated here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var img br wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME = {"li": ("li", "ul ol menu"), "dd": ("dd dt", "dl"), "dt": ("dd dt", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "table tr"), "th": ("td th", "table tr"), "option": ("option", "select")}
UNSEEN = frozenset("head title script style template noscript button select option textarea input iframe svg math object canvas audio video dialog".split())
BOILER_TAGS = frozenset("nav footer aside form menu".split())
BOILER_WORDS = frozenset("ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies copyright disqus footer form header login masthead menu menubar modal nav navbar navigation newsletter notice notification pager pagination popup promo promoted related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe teaser toc toolbar widget widgets complementary contentinfo alert".split())
MAIN_WORDS = frozenset("article articlebody body content entry main post story text".split())
TAGS = ("article", "main", "section", "div", "p", "h1", "h2", "h3", "h4", "li", "ul", "ol", "table", "tr", "td", "blockquote", "pre", "figure", "header", "footer", "nav", "aside", "form", "dl", "body", "html")
MORE = 16  # buckets of further tokens

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_TOKEN = re.compile(r"[a-z]+")
_TAG_PLACE = {t: i for i, t in enumerate(TAGS)}


class Node:
    __slots__ = ("tag", "parent", "depth", "words", "hidden", "text", "link", "marks", "tags", "kids", "nth", "blocks")

    def __init__(self, tag: str, parent: int, depth: int, words: frozenset, hidden: bool, nth: int):
        self.tag, self.parent, self.depth, self.words, self.hidden, self.nth = tag, parent, depth, words, hidden, nth
        self.text = self.link = self.marks = self.tags = self.kids = self.blocks = 0


def _attributes(text: str) -> tuple[frozenset, bool]:
    words, hidden = set(), False
    for m in _ATTRIBUTE.finditer(text):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif name in ("hidden", "aria-hidden"):
            hidden |= value != "false"
        else:
            words.update(_TOKEN.findall(value))
    return frozenset(words), hidden


def read(page: str | None) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block elements in page order, parents first, and the text blocks as (element, text)."""
    page = page or ""
    nodes = [Node("#page", -1, 0, frozenset(), False, 0)]
    stack: list[tuple[str, int]] = [("#page", 0)]  # open elements, with the block element that they are in
    blocks: list[tuple[int, str]] = []
    run: list[str] = []
    links = 0

    def flush() -> None:
        text = " ".join("".join(run).split()) if run else ""
        run.clear()
        if text:
            at = stack[-1][1]
            nodes[at].text += len(text)
            nodes[at].marks += sum(map(text.count, ".,;:!?"))
            nodes[at].blocks += 1
            blocks.append((at, text))

    def close(down_to: int) -> None:
        nonlocal links
        while len(stack) > down_to:
            tag = stack[-1][0]
            if tag not in INLINE:
                flush()
            if tag == "a":
                links -= 1
            stack.pop()

    def say(text: str) -> None:
        if text:
            text = html.unescape(text)
            run.append(text)
            if links:
                nodes[stack[-1][1]].link += len(text)

    at, size = 0, len(page)
    while at < size:
        m = _MARKUP.search(page, at)
        if not m:
            say(page[at:])
            break
        say(page[at : m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            continue
        if tag in CLOSES_P or tag in SAME:
            shut, within = SAME.get(tag, ("p", "")) if tag in SAME else ("p", "button")
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in shut.split():
                    close(i)
                    if tag != "tr":
                        break
                elif stack[i][0] in within.split():
                    break
        inside = nodes[stack[-1][1]]
        inside.tags += 1
        if tag in ("br", "wbr", "img"):
            run.append(" ")
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif tag in INLINE:
            if not m[3].rstrip().endswith("/"):
                stack.append((tag, stack[-1][1]))
                links += tag == "a"
        else:
            flush()
            words, hidden = _attributes(m[3]) if m[3].strip() else (frozenset(), False)
            nodes.append(Node(tag, stack[-1][1], inside.depth + 1, words, hidden, inside.kids))
            inside.kids += 1
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[^>]*>", re.I).search(page, at)
                at = end.end() if end else size
            else:
                stack.append((tag, len(nodes) - 1))
    close(1)
    flush()
    return nodes, blocks


def features(nodes: list[Node]) -> np.ndarray:
    n = len(nodes)
    parent = np.array([max(0, x.parent) for x in nodes])
    own = np.array([(x.text, x.link, x.marks, x.tags, x.blocks, 1) for x in nodes], float)
    deep = own.copy()
    for i in range(n - 1, 0, -1):  # children come after their parents
        deep[parent[i]] += deep[i]
    text, link, marks, tags, blocks, size = deep.T
    base = np.array([(x.depth, x.nth, nodes[max(0, x.parent)].kids, x.kids, x.hidden, x.tag in UNSEEN, x.tag in BOILER_TAGS, len(x.words & BOILER_WORDS), len(x.words & MAIN_WORDS)) for x in nodes], float)
    out = np.zeros((n, WIDTH), np.float32)
    whole = max(1.0, text[0])
    out[:, 0:9] = base
    out[:, 9] = np.log1p(own[:, 0])
    out[:, 10] = np.log1p(text)
    out[:, 11] = link / np.maximum(text, 1)
    out[:, 12] = marks / np.maximum(text, 1)
    out[:, 13] = text / (tags + size)
    out[:, 14] = text / np.maximum(blocks, 1)
    out[:, 15] = text / whole
    out[:, 16] = text / np.maximum(1, text[parent])
    out[:, 17] = np.log1p(size)
    above = base[:, 4:9].copy()
    article = np.array([x.tag in ("article", "main") for x in nodes], float)
    for i in range(1, n):
        above[i] += above[parent[i]]
        article[i] += article[parent[i]]
    out[:, 18:23] = above[parent]
    out[:, 23] = article
    out[:, 24] = article.max(initial=0)
    out[:, 25] = np.cumsum(own[:, 0]) / whole
    for i, x in enumerate(nodes):
        place = _TAG_PLACE.get(x.tag)
        if place is not None:
            out[i, NUMBERS + place] = 1
        for word in x.words:
            out[i, NUMBERS + len(TAGS) + sum(word.encode()) % MORE] = 1
    return out


NUMBERS = 26
WIDTH = NUMBERS + len(TAGS) + MORE
#: What is blanked in a quarter of the training rows: everything that the weak labels read.
BLANKED = [5, 6, 7, 8, 19, 20, 21, 22, 23, 24, *range(NUMBERS, WIDTH)]


def weak_labels(nodes: list[Node], blocks: list[tuple[int, str]]) -> np.ndarray:
    """1 for elements that hold main text, by the markup alone."""
    n = len(nodes)
    bad, inside = np.zeros(n, bool), np.zeros(n, bool)
    for i, x in enumerate(nodes):
        up = max(0, x.parent)
        inside[i] = inside[up] or x.tag in ("article", "main") or "articlebody" in x.words
        flagged = x.words & BOILER_WORDS and not (x.words & MAIN_WORDS and x.tag in ("article", "main", "body"))
        bad[i] = (i and bad[up]) or x.hidden or x.tag in UNSEEN or x.tag in BOILER_TAGS or bool(flagged) or (x.tag == "header" and not inside[up])
    any_main = inside.any()
    good = np.zeros(n, int)
    for at, _ in blocks:
        x = nodes[at]
        if not bad[at] and (inside[at] or (not any_main and x.link * 3 < x.text)):
            good[at] = 1
    for i in range(n - 1, 0, -1):
        good[nodes[i].parent] |= good[i]
    return good


MAIN_MARKUP = (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ('<div id="main-text">', "</div>"), ('<div class="post-body">', "</div>"), ("<section>", "</section>"), ("<div>", "</div>"))
BOILER_MARKUP = (
    '<div class="{w}">{t}</div>', '<div id="{w}-box"><p>{t}</p></div>', '<section class="site-{w}"><h3>{t}</h3><p>{t}</p><p>{t}</p></section>', '<div class="{w}"><div><p>{t}</p></div><div><p>{t}</p></div></div>',
    "<aside><h4>{t}</h4><p>{t}</p></aside>", '<ul class="{w}"><li><a href="#">{t}</a></li><li><a href="#">{t}</a></li></ul>', "<form><label>{t}</label><input><p>{t}</p></form>", "<footer><p>{t}</p></footer>", '<header><h1>{t}</h1><a href="/">{t}</a></header>', "<nav><a>{t}</a><a>{t}</a></nav>",
)


CONTENT_MARKUP = ("<h2>{t}</h2><p>{t}</p>", "<ul><li>{t}</li><li>{t}</li><li>{t}</li></ul>", "<ol><li>{t}</li><li>{t}</li></ol>", "<blockquote><p>{t}</p></blockquote>", "<table><tr><td>{t}</td><td>{t}</td></tr></table>", "<pre>{t}</pre>", "<div><p>{t}</p><p>{t}</p></div>", "<figure><figcaption>{t}</figcaption></figure>")


def variant(page: str, sentences: list[str], rng: np.random.Generator) -> str:
    """The page with another main element, further content in it, and further boilerplate before, in and after it."""
    words = sorted(BOILER_WORDS)
    pick = lambda many: many[rng.integers(len(many))]

    def filled(markup: str) -> str:
        parts = markup.split("{t}")
        return "".join(x for part in parts[:-1] for x in (part, pick(sentences))) + parts[-1]

    def boiler() -> str:
        return filled(pick(BOILER_MARKUP).replace("{w}", pick(words)))

    begin, end = page.find("<article>"), page.rfind("</article>")
    if begin < 0 or end < begin:
        at = page.find("<body>")
        return page if at < 0 else page[: at + 6] + boiler() + page[at + 6 :]
    opening, closing = pick(MAIN_MARKUP)
    main = page[begin + 9 : end]
    for more in ([boiler()] if rng.random() < 0.5 else []) + [filled(pick(CONTENT_MARKUP)) for _ in range(rng.integers(4))]:
        cut = main.find("<p>", int(rng.integers(max(1, len(main)))))
        cut = len(main) if cut < 0 else cut
        main = main[:cut] + more + main[cut:]
    some = lambda: "".join(boiler() for _ in range(rng.integers(3)))
    return page[:begin] + some() + opening + main + closing + some() + page[end + 10 :]


@dataclass
class Forest:
    """Complete binary trees over binned features: bin edges, and for each tree its splits and leaves."""

    edges: list[np.ndarray]
    splits: np.ndarray  # trees x inner nodes: feature
    cuts: np.ndarray  # trees x inner nodes: the last bin that goes left
    leaves: np.ndarray  # trees x leaves
    base: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.uint8)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        binned, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        inner = self.splits.shape[1]
        for split, cut, leaf in zip(self.splits, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            while at.size and at[0] < inner:
                at = 2 * at + 1 + (binned[rows, split[at]] > cut[at])
            out += leaf[at - inner]
        return out


def train(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 5, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> Forest:
    """Gradient boosting of the logistic loss, each level split by histograms of gradients and curvatures."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])] if len(x) else [np.zeros(0)] * x.shape[1]
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    inner = (1 << depth) - 1
    forest = Forest(edges, np.zeros((trees, inner), np.int64), np.full((trees, inner), 255, np.int64), np.zeros((trees, inner + 1)), float(np.log(share / (1 - share))))
    if not len(x):
        return forest
    binned = forest.bins(x)
    odds = np.full(len(x), forest.base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-odds))
        g, h = p - y, p * (1 - p)
        at = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, n = (1 << level) - 1, 1 << level
            best = np.full(n, 1e-6)
            split, cut = np.zeros(n, np.int64), np.full(n, 255)
            for j in range(x.shape[1]):
                if not len(edges[j]):
                    continue
                key = (at - first) * (bins + 1) + binned[:, j]
                gs = np.bincount(key, g, n * (bins + 1)).reshape(n, -1).cumsum(1)
                hs = np.bincount(key, h, n * (bins + 1)).reshape(n, -1).cumsum(1)
                gain = gs**2 / (hs + ridge) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + ridge) - gs[:, -1:] ** 2 / (hs[:, -1:] + ridge)
                top = gain.argmax(1)
                better = gain[np.arange(n), top] > best
                best[better], split[better], cut[better] = gain[np.arange(n), top][better], j, top[better]
            forest.splits[t, first : first + n], forest.cuts[t, first : first + n] = split, cut
            at = 2 * at + 1 + (binned[np.arange(len(x)), split[at - first]] > cut[at - first])
        leaf = at - inner
        forest.leaves[t] = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        odds += forest.leaves[t][leaf]
    return forest


def decode(nodes: list[Node], odds: np.ndarray) -> np.ndarray:
    """Keep or drop for each element: the likeliest choice in which nothing is kept below a dropped element."""
    keep, drop = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    below = np.zeros(len(nodes))
    for i in range(len(nodes) - 1, 0, -1):
        keep[i] += below[i]
        up = nodes[i].parent
        below[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    out = np.zeros(len(nodes), bool)
    out[0] = True
    for i in range(1, len(nodes)):
        out[i] = out[nodes[i].parent] and keep[i] >= drop[i]
    return out


def main_texts(pages: list[str | None], forest: Forest) -> list[str]:
    read_pages = [read(p) for p in pages]
    if not read_pages:
        return []
    odds = forest.log_odds(np.concatenate([features(nodes) for nodes, _ in read_pages]))
    out, at = [], 0
    for nodes, blocks in read_pages:
        kept = decode(nodes, odds[at : at + len(nodes)])
        at += len(nodes)
        out.append("\n".join(text for i, text in blocks if kept[i]))
    return out


def fit(pages: DataFrame, page_id: str = "page_id", html_: str = "html", most: int = 300) -> Forest:
    """Train on a bounded sample: ``most`` whole pages at the most, chosen by a hash of id and page."""
    rows = pages.select(F.col(page_id).alias("doc_id"), F.col(html_).alias("html"), F.lit(0).alias("all"))
    sample = common.bounded_sample(rows, "all", most)

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for page in pdf["html"]:
                nodes, blocks = read(page)
                rng = np.random.default_rng(zlib.crc32((page or "").encode("utf-8", "replace")))
                sentences = [x + "." for _, text in blocks for x in text.split(". ")] or ["."]
                for nodes, blocks in [(nodes, blocks), *[read(variant(page or "", sentences, rng)) for _ in range(3)]]:
                    yield pd.DataFrame({"x": [features(nodes).tobytes()], "y": [weak_labels(nodes, blocks).astype(np.int8).tobytes()]})

    got = sample.select("html").mapInPandas(rows_of, "x binary, y binary").toPandas().sort_values(["x", "y"])
    x = np.concatenate([np.zeros((0, WIDTH), np.float32), *[np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in got["x"]]])
    y = np.concatenate([np.zeros(0, np.int8), *[np.frombuffer(b, np.int8) for b in got["y"]]])
    some = np.arange(len(x)) % 3 == 0
    blank = x[some]
    blank[:, BLANKED] = 0
    return train(np.concatenate([x, blank]), np.concatenate([y, y[some]]).astype(float))


def extract(pages: DataFrame, forest: Forest, html_: str = "html") -> DataFrame:
    """pages with main_text."""
    held = pages.sparkSession.sparkContext.broadcast(forest)

    @F.pandas_udf("string")
    def column(texts: pd.Series) -> pd.Series:
        every = texts.tolist()
        return pd.Series([t for lo in range(0, len(every), 256) for t in main_texts(every[lo : lo + 256], held.value)], dtype=object)

    return pages.withColumn("main_text", column(F.col(html_)))
