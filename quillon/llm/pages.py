"""Main text of web pages by a tree-structured graphical model.

A page is a tree of element nodes and leaves with a block's text each (``dom.Page``).  Every node is
content or not.  A node's own potential is linear in what can be seen of it (tag, words of its names, text,
links); potentials of parent and child, one table for each kind of child, say how a child follows its
parent.  Messages are summed from the leaves to the root and back, which gives each leaf's exact marginal of
being content; leaves from a half on make the text, in the page's order.

The potentials are fitted to labelled pages by gradient ascent on the conditional likelihood, whose gradient
is what the labels have less what the same messages expect.  ``labelled_pages`` lays random texts out as
pages of many forms with known labels; any table of pages marked with ``data-content`` may be given instead.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import small_batches
from .common import free_name, tidy
from .dom import HEADINGS, Page

#: Labelled pages that the query makes, and the most that a model is fitted to.
PAGES, MOST_PAGES = 600, 2000
#: Steps of the fit at most, those it remembers, and the weight of the squared potentials.
STEPS, MEMORY, DECAY = 300, 12, 1e-5
SEED = 4_243

# Words of names (class, id, role and so on) by what they tell.
NAMES = {
    "main": "article articlebody blog body content entry main post prose story text",
    "menu": "breadcrumb breadcrumbs menu nav navbar navigation pager pagination tabs toc topbar",
    "header": "banner brand header logo masthead",
    "footer": "bottom colophon copyright foot footer legal",
    "side": "aside rail related sidebar widget recommended trending popular",
    "advert": "ad ads adsense advert advertisement advertising dfp promo promoted promotion sponsor sponsored",
    "notice": "alert announcement consent cookie cookies gdpr modal notice notification overlay popup privacy toast warning",
    "comments": "comment commentary commentlist comments discussion disqus replies reply responses",
    "form": "contact form login newsletter search signin signup subscribe subscription survey",
    "share": "author byline follow meta share sharing social tags",
}
KIND = {w: k for k, words in NAMES.items() for w in words.split()}
NAMED = ("class", "id", "role", "aria-label", "itemprop", "data-component")
TAGS = ["#text", "html", "article", "main", "section", "div", "p", "heading", "list", "item", "table", "cell", "nav", "header", "footer", "aside", "form", "quote", "other"]
TAG_OF = {"#text": 0, "html": 1, "article": 2, "main": 3, "section": 4, "div": 5, "center": 5, "p": 6, "ul": 8, "ol": 8, "dl": 8, "li": 9, "dt": 9, "dd": 9, "table": 10, "tbody": 10, "thead": 10, "tfoot": 10, "tr": 10, "td": 11, "th": 11, "nav": 12, "menu": 12, "header": 13, "footer": 14, "aside": 15, "form": 16, "fieldset": 16, "dialog": 16, "search": 16, "blockquote": 17, "pre": 17, "figure": 17, "figcaption": 17} | dict.fromkeys(HEADINGS, 7)
KINDS = list(NAMES)
LENGTHS, SHARES, LINKS = (12, 40, 100, 250, 600), (0.02, 0.1, 0.3, 0.6), (0.01, 0.25, 0.5, 0.85)
#: Elements that hold others; the rest (text, paragraphs, headings, items, cells) have no features of kind and size, so
#: that many plain children say nothing about their parent.
BOXES = [1, 2, 3, 4, 5, 8, 10, 12, 13, 14, 15, 16]
#: Kinds of children: text, paragraphs, headings, parts of lists and tables, plain boxes, marked as main, marked
#: otherwise.  The first PLAIN are alike to their parent or not, with one weight; the others have a table.
EDGES, PLAIN = 7, 4
COLUMNS = len(TAGS) + len(KINDS) + 5 + len(LENGTHS) + 1 + 2 * (len(LINKS) + 1) + len(SHARES) + 1
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Forest(NamedTuple):
    """Nodes of several pages, parents before children: their features, the kind of each node as a child, and depth."""

    x: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    depth: np.ndarray


class Model(NamedTuple):
    """``own`` has a weight for each feature, ``pair`` a table (parent, child) for each kind of child."""

    own: np.ndarray
    pair: np.ndarray


def _names(attributes: dict[str, str]) -> tuple[set[str], bool]:
    kinds = set()
    for a in NAMED:
        if a in attributes:
            for w in WORDS.findall(attributes[a]):
                kinds.add(KIND.get(w.lower()))
    style = attributes.get("style", "").replace(" ", "").lower()
    hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
    return kinds - {None}, hidden


def forest(pages: list[Page]) -> Forest:
    """What can be seen of the pages' nodes."""
    sizes = [len(p.parent) for p in pages]
    first = np.cumsum(sizes) - sizes
    n = sum(sizes)
    x = np.zeros((n, COLUMNS))
    parent, end, depth, chars, linked, edge, kind = (np.zeros(n, np.int64) for _ in range(7))
    at = 0
    kinds_from, text_from = len(TAGS), len(TAGS) + len(KINDS)
    for p, begin in zip(pages, first.tolist()):
        for i, (tag, attributes, text) in enumerate(zip(p.tags, p.attributes, p.texts)):
            t = TAG_OF.get(tag, len(TAGS) - 1)
            marked = t in (12, 13, 14, 15, 16)
            edge[at] = 6 if marked else 5 if t in (2, 3) else 0 if t == 0 else 1 if t in (6, 17) else 2 if t == 7 else 3 if t in (8, 9, 10, 11) else 4
            if attributes:
                kinds, hidden = _names(attributes)
                for k in kinds:
                    x[at, kinds_from + KINDS.index(k)] = 1
                if kinds - {"main"} or hidden:
                    edge[at] = 6
                elif kinds and not marked:
                    edge[at] = 5
                x[at, text_from] = hidden
            if text is not None:
                chars[at], linked[at] = len(text), p.linked[i]
                x[at, text_from + 1] = "©" in text
            x[at, text_from + 2] = tag == "h1"
            parent[at], end[at], depth[at] = (p.parent[i] + begin if i else -1), p.end[i] + begin, p.depth[i]
            kind[at] = t
            at += 1
    total = lambda v: np.concatenate([[0], np.cumsum(v)])
    below = lambda v: total(v)[end] - total(v)[np.arange(n)]
    inner, links = below(chars), below(linked)
    page = np.repeat(np.arange(len(pages)), sizes)
    whole = np.maximum(1, inner[first])[page] if n else inner
    share = np.searchsorted(LINKS, links / np.maximum(1, inner), "right")
    c = text_from + 5
    leaves, boxes = np.flatnonzero(kind == 0), np.flatnonzero(np.isin(kind, BOXES))
    leaves = leaves[share[leaves] > 0]
    x[leaves, c + share[leaves]] = 1
    c += len(LINKS) + 1
    x[boxes, c + share[boxes]] = 1
    c += len(LINKS) + 1
    x[boxes, kind[boxes]] = 1
    x[boxes, c + np.searchsorted(LENGTHS, inner[boxes], "right")] = 1
    c += len(LENGTHS) + 1
    x[boxes, c + np.searchsorted(SHARES, (inner / whole)[boxes], "right")] = 1
    paragraphs = np.bincount(parent[(kind == TAGS.index("p")) & (parent >= 0)], minlength=n)
    x[boxes, text_from + 3] = paragraphs[boxes] > 0
    x[boxes, text_from + 4] = paragraphs[boxes] > 2
    return Forest(x, parent, edge, depth)


class _Levels:
    """The forest by depth: for each level its nodes, in order of their parents, and where each parent's begin."""

    def __init__(self, f: Forest):
        order = np.lexsort((f.parent, f.depth))
        self.rows, self.firsts = [], []
        for rows in np.split(order, np.searchsorted(f.depth[order], np.arange(1, int(f.depth.max(initial=0)) + 1)))[1:]:
            self.rows.append(rows)
            self.firsts.append(np.flatnonzero(np.diff(f.parent[rows], prepend=-2)))


def marginals(model: Model, f: Forest, levels: _Levels | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each node's probability of being content, (parent, child) probabilities of each node with its parent, and
    what comes from below each node.

    Sum-product: messages go up by depth, then down; both passes are exact on trees.
    """
    levels = levels or _Levels(f)
    below = np.zeros((len(f.parent), 2))
    below[:, 1] = f.x @ model.own
    pair = model.pair[f.edge]
    up, down = np.zeros_like(below), np.zeros_like(below)
    for rows, first in zip(reversed(levels.rows), reversed(levels.firsts)):
        a = pair[rows] + below[rows][:, None, :]
        up[rows] = np.logaddexp(a[:, :, 0], a[:, :, 1])
        below[f.parent[rows[first]]] += np.add.reduceat(up[rows], first)
    for rows in levels.rows:
        p = f.parent[rows]
        a = pair[rows] + (below[p] + down[p] - up[rows])[:, :, None]
        down[rows] = np.logaddexp(a[:, 0], a[:, 1])
    belief = below + down
    node = 1 / (1 + np.exp(np.clip(belief[:, 0] - belief[:, 1], -700, 700)))
    p = np.maximum(f.parent, 0)
    joint = pair + (below[p] + down[p] - up)[:, :, None] + below[:, None, :]
    joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    joint[f.parent < 0] = 0
    return node, joint, below


def _by_kind(f: Forest, joint: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(f.edge, joint[:, a, b], EDGES) for a in (0, 1) for b in (0, 1)], 1)


def _tied(w: np.ndarray) -> np.ndarray:
    """The tables of plain children with one weight each."""
    pair = w[COLUMNS:].reshape(EDGES, 2, 2).copy()
    alike = (pair[:PLAIN, 0, 0] + pair[:PLAIN, 1, 1]) / 2
    pair[:PLAIN] = alike[:, None, None] * np.eye(2)
    return np.concatenate([w[:COLUMNS], pair.ravel()])


def fit_forest(f: Forest, y: np.ndarray) -> Model:
    """Potentials for which the labels ``y`` (0 or 1 for each node) are most likely.

    The likelihood is concave; it is climbed by L-BFGS, which shapes a step by the slopes of the last ones.
    """
    true, child = np.zeros((len(y), 2, 2)), np.flatnonzero(f.parent >= 0)
    true[child, y[f.parent[child]], y[child]] = 1
    seen, levels, roots = np.concatenate([f.x.T @ y, _by_kind(f, true).ravel()]), _Levels(f), f.parent < 0

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        node, joint, below = marginals(Model(w[:COLUMNS], w[COLUMNS:].reshape(EDGES, 2, 2)), f, levels)
        whole = np.logaddexp(below[roots, 0], below[roots, 1]).sum()
        expected = np.concatenate([f.x.T @ node, _by_kind(f, joint).ravel()])
        return (whole - w @ seen) / len(y) + DECAY / 2 * w @ w, _tied((expected - seen) / len(y) + DECAY * w)

    w = np.zeros(COLUMNS + EDGES * 4)
    now, slope = loss(w)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(STEPS):
        step, kept = -slope, []
        for s, t in reversed(past):
            kept.append(s @ step / (s @ t))
            step = step - kept[-1] * t
        if past:
            step *= past[-1][0] @ past[-1][1] / (past[-1][1] @ past[-1][1])
        for (s, t), k in zip(past, reversed(kept)):
            step = step + (k - t @ step / (s @ t)) * s
        size = 1.0 if past else 1 / np.abs(slope).sum()
        while True:
            after, new_slope = loss(w + size * step)
            if after <= now + 1e-4 * size * (slope @ step) or size < 1e-6:
                break
            size /= 2
        s, t = size * step, new_slope - slope
        w, done, now, slope = w + s, now - after < 1e-7 * now, after, new_slope
        if done or s @ t <= 0:
            break
        past = [*past, (s, t)][-MEMORY:]
    return Model(w[:COLUMNS], w[COLUMNS:].reshape(EDGES, 2, 2))


def labels_of(page: Page) -> np.ndarray:
    """0 or 1 for each node, from ``data-content`` of the nearest ancestor; elements around content, most of their text."""
    own, chars, content = [0] * len(page.parent), [0] * len(page.parent), [0] * len(page.parent)
    for i, (attributes, text) in enumerate(zip(page.attributes, page.texts)):
        inherited = own[page.parent[i]] if i else 0
        own[i] = int(attributes["data-content"] == "1") if "data-content" in attributes else inherited
        if text is not None:
            chars[i], content[i] = len(text), own[i] * len(text)
    for i in range(len(own) - 1, 0, -1):
        chars[page.parent[i]] += chars[i]
        content[page.parent[i]] += content[i]
    return np.array([int(o or 2 * c > n) for o, n, c in zip(own, chars, content)])


def fit(labelled: DataFrame, *, html_col: str = "html", most: int = MOST_PAGES) -> Model:
    """A model fitted to at most ``most`` of the labelled pages, the first in order of their hash.

    Null pages count as empty ones; without pages all marginals are a half.
    """
    first = labelled.select(F.coalesce(F.col(html_col), F.lit("")).alias("html")).orderBy(F.xxhash64("html"), "html").limit(most)
    pages = [Page(r["html"]) for r in first.collect()]
    if not pages:
        return Model(np.zeros(COLUMNS), np.zeros((EDGES, 2, 2)))
    return fit_forest(forest(pages), np.concatenate([labels_of(p) for p in pages]))


def main_text(pages: list[Page], model: Model) -> list[str]:
    f = forest(pages)
    node = marginals(model, f)[0]
    out, at = [], 0
    for p in pages:
        out.append("\n".join(t for t, m in zip(p.texts, node[at : at + len(p.texts)].tolist()) if t is not None and m >= 0.5))
        at += len(p.texts)
    return out


def extract_text(pages: DataFrame, model: Model, *, html_col: str = "html") -> DataFrame:
    """``pages`` with ``text`` instead of the html: the blocks of main text, joined by line feeds.

    Character references are decoded, white space inside a block becomes one space, and nothing else of a
    content block is dropped.  Null and empty pages, and pages without text, give an empty text; repeated rows
    have the same text; an empty table gives no rows; pages of any length are read whole, in memory in proportion
    to their length; other columns stay, and a column called ``text`` is replaced.
    """
    small_batches(pages.sparkSession)
    rest = [c for c in pages.columns if c.lower() not in ("text", html_col.lower())]
    row = free_name("_row", rest)
    whole = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(0).alias("none"))
    sent = pages.select(whole.alias(row), F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("_html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 100):
                part = b.slice(i, 100)
                texts = main_text([Page(x) for x in part.column(1).to_pylist()], model)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["_row", "_text"])

    out = sent.mapInArrow(tidy(run), f"_row {sent.schema[row].dataType.simpleString()}, _text string")
    return out.select(*[F.col(f"_row.`{c}`").alias(c) for c in rest], F.col("_text").alias("text"))


# Labelled pages.  Content and the rest are laid out in many forms; words are random syllables.


class _Layout:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.syllables = ["".join(self.r.choices("bcdfghjklmnprstvwz", k=1) + self.r.choices("aeiouéüñ", k=1) + self.r.choices(["", "n", "r", "s"], k=1)) for _ in range(40)]

    def words(self, low: int, high: int) -> str:
        out = ["".join(self.r.choices(self.syllables, k=self.r.choice([1, 1, 2, 3]))) for _ in range(self.r.randint(low, high))]
        text = " ".join(out).capitalize()
        return self.r.choice([text + ".", text, text + "!", text.replace(" ", ", ", 1) + ".", text + " &amp; co."]) if self.r.random() < 0.9 else text.upper() + "!!"

    def name(self, kind: str) -> str:
        """A class or id with a word of that kind, in one of the usual ways of writing."""
        word = self.r.choice(NAMES[kind].split())
        more = self.r.choice(["site", "page", "top", "wrap", "inner", "box", "x1", "block", "left", "list"])
        form = self.r.choice(["{0}", "{0}", "{0}-{1}", "{1}-{0}", "{0}_{1}", "{1}{2}", "{0} {1}", "js-{0}"])
        return f' {self.r.choice(["class", "class", "id"])}="{form.format(word, more, word.capitalize())}"'

    def plain(self) -> str:
        return self.r.choice(["", "", ' class="row"', ' class="col-8 wrap"', ' id="page"', ' class="container"', ' class="inner"'])

    def links(self, low: int, high: int) -> str:
        items = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(self.r.randint(low, high))]
        style = self.r.randrange(4)
        if style == 0:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        if style == 1:
            return "<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>"
        return self.r.choice([" | ", " ", " &middot; "]).join(items) if style == 2 else "".join(f"<div>{x}</div>" for x in items)

    def paragraph(self) -> str:
        low, high = self.r.choice([(1, 4), (5, 20), (20, 60), (60, 120)])
        text = self.words(low, high)
        if self.r.random() < 0.2:
            text += f' <a href="#">{self.words(1, 3)}</a> {self.words(2, 9)}'
        return self.r.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p class='text'>{}</p>", "<div>{}</div>", "<blockquote>{}</blockquote>", "<p><span>{}</span></p>"]).format(text)

    def content(self) -> str:
        out = [f"<h1>{self.words(2, 10)}</h1>"] if self.r.random() < 0.85 else []
        if out and self.r.random() < 0.2:
            out = [f"<header>{out[0]}</header>"]
        for _ in range(self.r.choice([1, 2, 4, 8, 15, 40])):
            x = self.r.random()
            if x < 0.78:
                out.append(self.paragraph())
            elif x < 0.86:
                out.append(f"<h2>{self.words(1, 8)}</h2>")
            elif x < 0.93:
                out.append("<ul>" + "".join(f"<li>{self.words(1, 15)}</li>" for _ in range(self.r.randint(1, 6))) + "</ul>")
            elif x < 0.96:
                out.append("<table>" + "".join(f"<tr><td>{self.words(1, 4)}</td><td>{self.words(1, 4)}</td></tr>" for _ in range(3)) + "</table>")
            else:
                out.append(f"<pre>{self.words(3, 20)}</pre>")
            if self.r.random() < 0.08:
                out.append(self.other(self.r.choice(["advert", "side", "share", "form", "notice"])))
        if self.r.random() < 0.2:
            out.append(self.other(self.r.choice(["comments", "comments", "footer", "share"])))
        return "".join(out)

    def other(self, kind: str) -> str:
        """A block that is no content, marked by its tag, its names or both."""
        r = self.r
        text = {
            "menu": lambda: self.links(2, 10),
            "header": lambda: r.choice(["<h1>{}</h1>", "<h2>{}</h2>", "<p>{}</p>", "<div>{}</div>", "<a href='/'>{}</a>"]).format(self.words(1, 5)) + (self.links(2, 6) if r.random() < 0.4 else ""),
            "footer": lambda: r.choice(["&copy; {}", "&copy; {}", "<p>{}</p>", "<p>&copy; 2024 {}</p>"]).format(self.words(1, 14)) + (self.links(1, 5) if r.random() < 0.4 else ""),
            "side": lambda: f"<h3>{self.words(1, 4)}</h3>" + r.choice([self.links(2, 8), f"<p>{self.words(5, 60)}</p>"]),
            "advert": lambda: r.choice(["{}", "<p>{}</p>", "<a href='#'>{}</a>", "<div>{}</div>"]).format(self.words(2, 40)),
            "notice": lambda: r.choice(["{}", "<p>{}</p>", "<p>{}</p><button>OK</button>"]).format(self.words(4, 40)),
            "comments": lambda: r.choice(["", "<h3>" + self.words(1, 3) + "</h3>"]) + "".join(r.choice(["<div{0}>{1}</div>", "<li{0}>{1}</li>", "<article{0}>{1}</article>", "<p>{1}</p>"]).format(self.name("comments"), f"<p>{self.words(3, 50)}</p>") for _ in range(r.choice([1, 2, 4, 8, 15]))),
            "form": lambda: f"<label>{self.words(1, 3)}</label><input name='q'><p>{self.words(2, 12)}</p><button>Go</button>",
            "share": lambda: r.choice([self.links(2, 5), self.words(1, 5)]),
        }[kind]()
        if kind != "menu" and r.random() < 0.35:  # paragraphs like those of content
            text = (f"<h{r.choice('234')}>{self.words(1, 4)}</h2>" if r.random() < 0.5 else "") + "".join(f"<p>{self.words(2, 50)}</p>" for _ in range(r.choice([1, 2, 4, 8, 16])))
        tag = {"menu": "nav", "header": "header", "footer": "footer", "side": "aside", "form": "form"}.get(kind)
        mark = self.name(kind)
        if tag and r.random() < 0.6:
            mark = mark if r.random() < 0.4 else ""
        else:
            tag = r.choice(["div", "div", "section", "ul" if text.startswith("<li") else "div"])
        if kind in ("notice", "advert", "share") and "<" not in text and r.random() < 0.3:
            tag = "p"
        return f'<{tag}{mark} data-content="0">{text}</{tag}>'

    def page(self) -> str:
        r = self.r
        body = self.content()
        form = r.randrange(5)
        if form == 0:
            body = f"<article{r.choice(['', self.name('main')])} data-content='1'>{body}</article>"
        elif form == 1:
            body = f"<main{self.plain()} data-content='1'>{body}</main>"
        elif form == 2:
            body = f"<div{self.name('main')} data-content='1'>{body}</div>"
        elif form == 3:
            body = f"<main><article data-content='1'>{body}</article></main>"
        else:
            tag = r.choice(["section", "div", "div"])
            body = f"<{tag}{self.plain()} data-content='1'>{body}</{tag}>"
        after = self.other("comments") if r.random() < 0.35 else ""
        for _ in range(r.randrange(3)):
            body = f"<div{self.plain()}>{body}</div>"
        before = [k for k, p in (("notice", 0.3), ("header", 0.6), ("menu", 0.8), ("advert", 0.45), ("form", 0.2)) if r.random() < p]
        behind = [k for k, p in (("side", 0.5), ("advert", 0.25), ("share", 0.25), ("form", 0.25), ("footer", 0.85), ("notice", 0.15)) if r.random() < p]
        if r.random() < 0.3:
            r.shuffle(before)
        out = "".join(map(self.other, before)) + body + after + "".join(map(self.other, behind))
        if r.random() < 0.1:
            out = f"<table><tr><td>{''.join(map(self.other, before))}</td><td>{body}{after}</td><td>{''.join(map(self.other, behind))}</td></tr></table>"
        return f'<!DOCTYPE html><html lang="xx"><head><title>{self.words(2, 8)}</title><style>p{{}}</style></head><body data-content="0">{out}</body></html>'


def labelled_pages(spark: SparkSession, n: int = PAGES, seed: int = SEED) -> DataFrame:
    """(html): ``n`` pages whose elements tell by ``data-content`` what their text is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_Layout(seed + i).page() for i in b.column(0).to_pylist()], pa.string())], ["html"])

    return spark.range(n).mapInArrow(run, "html string")


def op12_pages(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_text(pages, fit(labelled_pages(spark))).withColumn("n_chars", F.length("text").cast("long"))
