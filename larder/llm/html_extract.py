"""Main text of HTML pages by a tree-structured graphical model.

A page's block elements form a tree; each node is content or not. Node
potentials come from a node's features (tag, words of class and id, amount of
text, share of link text, marks of sentences), edge potentials from the labels
of parent and child. Sum-product messages up and then down the tree give every
node's exact content marginal; the text of nodes with a marginal of one half or
more is the page's main text. A batch of pages is one forest, passed level by level.

Training maximises the conditional likelihood of labelled pages with the same
messages: ``seed_trees`` (layouts made here by a rule, every node labelled: half
with an element that names itself the content, half with blocks right below the
body, containers of unknown names, table layouts or no tags at all), and a
bounded sample (``SAMPLE_PAGES``, by a hash over the whole table) of the pages
with just one article or main element, labelled by their semantic tags.

Text: character references are decoded, white space inside a block becomes one
space (a line break is white space), blocks are joined in page order by a
line feed. Scripts and styles never hold text; formulas and labels are inline text, what stands
in for media and buttons is a block that the model judges. A block left open
ends where HTML ends it; a tag that closes nothing is ignored.

Edge cases: a null or empty page, or one without content, has an empty text;
a page cut anywhere is read as far as it goes; a page without tags is one block;
repeated rows get equal results; pages of any length are read whole. Input columns
named like an output are replaced.
"""

from __future__ import annotations

import html
import random
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import add_columns, slices

SAMPLE_PAGES = 400
STEPS = 250
RATE = 0.05
RIDGE = 1e-3
SEEDS = 150

TAGS = {
    "article": "article", "main": "main", "section": "section", "div": "div", "body": "body", "p": "p", "li": "li",
    "ul": "list", "ol": "list", "dl": "list", "dd": "li", "dt": "li", "h1": "heading", "h2": "heading", "h3": "heading",
    "h4": "heading", "h5": "heading", "h6": "heading", "nav": "nav", "menu": "nav", "header": "header", "footer": "footer",
    "aside": "aside", "form": "form", "fieldset": "form", "table": "table", "thead": "table", "tbody": "table", "tfoot": "table",
    "tr": "table", "td": "cell", "th": "cell", "caption": "cell", "figure": "figure", "figcaption": "figure",
    "blockquote": "quote", "pre": "quote", "address": "address", "details": "section", "summary": "p", "dialog": "dialog",
    "hgroup": "section", "center": "div", "html": "html", "head": "hidden", "noscript": "hidden", "template": "hidden",
    "select": "hidden", "button": "form", "iframe": "hidden", "object": "figure", "svg": "hidden", "canvas": "hidden",
    "audio": "figure", "video": "figure"}
KINDS = sorted(set(TAGS.values()))
#: Elements that may stand inside a paragraph.
PHRASING = frozenset(("button", "object", "audio", "video"))
ENDS_P = frozenset(t for t, k in TAGS.items() if k not in ("hidden", "cell") and t not in ("html", "body", "tr", "thead", "tbody", "tfoot")
                   ) - PHRASING
#: A start tag ends an open element of its group, up to the element that holds such groups.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
HINTS = {
    "advert": ("ad", "ads", "advert", "advertisement", "sponsor", "sponsored", "promo", "banner", "adsense", "advertising"),
    "menu": ("nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "toc", "links"),
    "frame": ("header", "footer", "masthead", "topbar", "copyright", "legal", "site", "logo", "branding", "bottom"),
    "side": ("sidebar", "side", "aside", "widget", "related", "recommended", "trending", "popular", "teaser", "more"),
    "comments": ("comment", "comments", "reply", "replies", "discussion", "disqus", "responses", "respond", "feedback", "review"),
    "notice": ("cookie", "cookies", "consent", "notice", "alert", "popup", "modal", "newsletter", "subscribe", "signup", "gdpr",
               "overlay", "login", "toast", "message", "warning"),
    "social": ("share", "social", "sharing", "follow", "twitter", "facebook", "tags", "meta", "byline"),
    "content": ("content", "article", "post", "entry", "story", "text", "body", "main", "page", "prose"),
}
HINT_NAMES = list(HINTS)
HINT_OF = {w: HINT_NAMES.index(k) for k, words in HINTS.items() for w in words}
NAME_PARTS = re.compile("[a-z]+")
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title|textarea|noscript|template)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|</?[A-Za-z](?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|</?[A-Za-z][^>]*(?:>|\Z)|<[!?/][^>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
TAG_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
LABEL = re.compile(r"\bdata-keep=\"([01])\"")
SENTENCE = re.compile(r"[.!?,;:](?:\s|$)")


class Tree:
    """Nodes of a page in page order: parent, tag, hints, label; segments are (node, text, link characters).

    A training page holds its segments' ``measures`` instead of their texts.
    """

    __slots__ = ("parent", "tag", "hints", "label", "segments", "hidden", "measures")

    def __init__(self) -> None:
        self.parent, self.tag, self.hints, self.label, self.hidden = [-1], ["html"], [()], [None], [False]
        self.segments: list[tuple[int, str, int]] = []
        self.measures: list[tuple[int, int, int, int]] | None = None

    def add(self, parent: int, tag: str, hints: tuple, label: str | None) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.hints.append(hints)
        self.label.append(label)
        self.hidden.append(self.hidden[parent] or TAGS[tag] == "hidden")
        return len(self.parent) - 1

    def measured(self) -> list[tuple[int, int, int, int]]:
        """(node, characters, characters in links, sentence marks) of each segment."""
        if self.measures is not None:
            return self.measures
        return [(node, len(text), min(linked, len(text)), len(SENTENCE.findall(text))) for node, text, linked in self.segments]


def parse(page: str | None, labelled: bool = False) -> Tree:
    tree = Tree()
    stack = [(0, "html")]
    opened: Counter[str] = Counter()  # open elements by name, so that a name that is not open costs no search
    held: list[str] = []
    linked = in_link = 0

    def close_segment() -> None:
        nonlocal linked
        if held:
            node = stack[-1][0]
            if not tree.hidden[node]:
                text = " ".join("".join(held).split())
                if text:
                    tree.segments.append((node, text, linked))
            held.clear()
        linked = 0

    def pop_to(names: set | frozenset, limits: set | frozenset) -> None:
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][1] in names:
                close_segment()
                opened.subtract(t for _, t in stack[i:])
                del stack[i:]
                return
            if stack[i][1] in limits:
                return

    for m in TOKEN.finditer(page or ""):
        token = m.group()
        if token[0] != "<" or token == "<":
            text = html.unescape(token) if "&" in token else token
            held.append(text)
            if in_link:
                linked += len(text)
            continue
        if m[1] or token[1] in "!?":
            continue
        found = TAG_NAME.match(token)
        if not found:
            continue
        name = found[1].lower()
        if name not in TAGS:
            if name == "br":
                held.append(" ")
            elif name == "hr":
                close_segment()
            elif name == "a":
                in_link = int(token[1] != "/")
            continue
        if token[1] == "/":
            pop_to({name}, frozenset())
            continue
        close_segment()
        in_link = 0
        if name in ("html", "body") and opened[name]:
            continue
        if name in ENDS_P:
            pop_to({"p"}, {"td", "th", "table", "button", "object"})
        if name in SIBLINGS:
            pop_to(*SIBLINGS[name])
        hints: tuple = ()
        label = None
        if len(token) > len(name) + 2:
            hints = tuple(sorted({HINT_OF[w] for a in NAMES.finditer(token) for w in NAME_PARTS.findall((a[1] or a[2] or a[3] or "").lower())
                                  if w in HINT_OF}))
            if labelled and (y := LABEL.search(token)):
                label = y[1]
        stack.append((tree.add(stack[-1][0], name, hints, label), name))
        opened[name] += 1
    close_segment()
    return tree


#: Kinds whose descendants carry a mark of them.
REGIONS = ("article", "main", "nav", "header", "footer", "aside", "form", "dialog")
N_FEATURES = 1 + len(KINDS) + len(HINT_NAMES) * 2 + 16 + len(REGIONS) + 5


class Forest:
    """Pages' nodes laid end to end with their features and levels."""

    def __init__(self, trees: list[Tree]):
        sizes = [len(t.parent) for t in trees]
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.starts, n = starts, int(starts[-1])
        self.parent = np.concatenate([np.array(t.parent, np.int64) + (s if s else 0) for t, s in zip(trees, starts)]) if trees else np.zeros(0, np.int64)
        roots = starts[:-1]
        self.parent[roots] = -1
        self.hidden = np.concatenate([np.array(t.hidden, bool) for t in trees]) if trees else np.zeros(0, bool)
        depth = np.zeros(n, np.int64)
        own = np.zeros((n, 3))  # characters, characters in links, sentence marks
        kind = np.zeros(n, np.int64)
        hint = np.zeros((n, len(HINT_NAMES)))
        above = np.zeros((n, len(HINT_NAMES)))
        region = np.zeros((n, len(REGIONS)))
        at = 0
        for t in trees:
            base = at
            for i, p in enumerate(t.parent):
                kind[at] = KINDS.index(TAGS[t.tag[i]])
                if p >= 0:
                    depth[at] = depth[base + p] + 1
                    above[at] = above[base + p]
                    region[at] = region[base + p]
                if TAGS[t.tag[i]] in REGIONS:
                    region[at, REGIONS.index(TAGS[t.tag[i]])] = 1
                for h in t.hints[i]:
                    hint[at, h] = above[at, h] = 1
                at += 1
            for node, *measures in t.measured():
                own[base + node] += measures
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth)))[1:-1] if n else []
        whole = own.copy()
        for nodes in reversed(self.levels):
            np.add.at(whole, self.parent[nodes], whole[nodes])
        x = np.zeros((n, N_FEATURES))
        x[:, 0] = 1
        x[np.arange(n), 1 + kind] = 1
        j = 1 + len(KINDS)
        x[:, j:j + len(HINT_NAMES)] = hint
        x[:, j + len(HINT_NAMES):j + 2 * len(HINT_NAMES)] = above
        j += 2 * len(HINT_NAMES)
        for k, part in enumerate((own, whole)):
            chars, links, marks = part.T
            share = links / np.maximum(chars, 1)
            rate = marks / np.maximum(chars, 1) * 60
            x[:, j + 8 * k:j + 8 * k + 8] = np.stack([chars == 0, chars > 25, chars > 80, chars > 250, np.log1p(chars) / 8,
                                                      share, share > 0.5, np.minimum(rate, 2)], 1)
        j += 16
        x[:, j:j + len(REGIONS)] = region
        bad = above[:, [i for i, k in enumerate(HINT_NAMES) if k != "content"]].any(1) | region[:, 2:].any(1)
        heart = region[:, :2].any(1)
        j += len(REGIONS)
        x[:, j], x[:, j + 1] = heart & ~bad, ~heart & bad
        # Whether the page names its content anywhere: if so the rest of it is judged otherwise than on a page that does not.
        named = (heart | above[:, HINT_NAMES.index("content")].astype(bool)) & ~bad
        has = np.repeat(np.maximum.reduceat(named, roots), sizes) if n else named
        x[:, j + 2], x[:, j + 3], x[:, j + 4] = has & ~named, ~has & ~bad, ~has & bad
        self.x = x

    def marginals(self, weights: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Content marginal of each node, the edges' joint marginals (by child; parent, child), and the log partition sum."""
        n = len(self.parent)
        unary = np.zeros((n, 2))
        unary[:, 1] = self.x @ weights
        unary[self.hidden, 1] = -50.0
        up = unary.copy()  # own potential and the children's messages
        message = np.zeros((n, 2))
        for nodes in reversed(self.levels):
            message[nodes] = _log_sum(pair[None] + up[nodes][:, None, :], 2)
            np.add.at(up, self.parent[nodes], message[nodes])
        down = np.zeros((n, 2))
        joint = np.zeros((n, 2, 2))
        for nodes in self.levels:
            p = self.parent[nodes]
            rest = up[p] - message[nodes] + down[p]  # the parent's belief without this child
            both = rest[:, :, None] + pair[None] + up[nodes][:, None, :]
            joint[nodes] = np.exp(both - _log_sum(both.reshape(-1, 4), 1)[:, None, None])
            down[nodes] = _log_sum(rest[:, :, None] + pair[None], 1)
        belief = up + down
        p = np.exp(belief[:, 1] - _log_sum(belief, 1))
        return p, joint, _log_sum(up[self.starts[:-1]], 1) if n else np.zeros(0)


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis))


class Model:
    def __init__(self, weights: np.ndarray, pair: np.ndarray):
        self.weights, self.pair = weights, pair


def labels(tree: Tree) -> list[int] | None:
    """Each node's label: marked ones pass theirs down; else by the page's one article or main element."""
    n = len(tree.parent)
    if any(y is not None for y in tree.label):
        out = [0] * n
        for i, p in enumerate(tree.parent):
            out[i] = int(tree.label[i]) if tree.label[i] is not None else out[p] if p >= 0 else 0
        return out
    hearts = [i for i in range(n) if tree.tag[i] in ("article", "main")]
    if len(hearts) != 1:
        return None
    out, bad = [0] * n, {HINT_NAMES.index(h) for h in ("advert", "menu", "side", "comments", "notice", "social")}
    for i, p in enumerate(tree.parent):
        out[i] = int(i == hearts[0] or p >= 0 and out[p] == 1)
        if TAGS[tree.tag[i]] in ("nav", "footer", "aside", "form", "hidden", "dialog") or bad & set(tree.hints[i]):
            out[i] = 0
    return out


def fit(trees: list[Tree], steps: int = STEPS) -> Model:
    """Conditional likelihood by gradient steps (Adam): observed minus expected features."""
    pairs = [(t, y) for t in trees if (y := labels(t)) is not None]
    forest = Forest([t for t, _ in pairs])
    y = np.concatenate([np.array(v, float) for _, v in pairs])
    free = ~forest.hidden
    child = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[forest.parent[child]].astype(int), y[child].astype(int)), 1)
    theta = np.zeros(N_FEATURES + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    observed = np.concatenate([forest.x[free].T @ y[free], seen.ravel()]) / len(y)
    for step in range(1, steps + 1):
        p, joint, _ = forest.marginals(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2))
        expected = np.concatenate([forest.x[free].T @ p[free], joint.sum(0).ravel()]) / len(y)
        grad = observed - expected - RIDGE * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta += RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2))


def seed_pages(n: int = SEEDS, seed: int = 5) -> list[str]:
    """Labelled layouts: a content element among menus, notices, adverts, comments and the like, in many forms."""
    rng = random.Random(seed)
    vocabulary = "alder brook cedar delta ember field grove harbor island juniper kettle lantern meadow north orchard pebble".split()

    def words(low: int, high: int) -> str:
        text = " ".join(rng.choice(vocabulary) for _ in range(rng.randint(low, high)))
        return text[:1].upper() + text[1:]

    def prose(low: int = 1, high: int = 5) -> str:
        return " ".join(words(2, 14) + rng.choice([".", ".", ",", "?"]) for _ in range(rng.randint(low, high)))

    def links(k: int) -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 2)}</a></li>' for i in range(k))

    def one(*options: str) -> str:
        return rng.choice(options)

    def inner() -> str:
        parts = [f"<h1>{words(2, 9)}</h1>"] if rng.random() < 0.8 else []
        for _ in range(rng.choice([1, 1, 2, 3, 4, 5, 7])):
            parts.append(one(
                f"<p>{prose()}</p>", f"<p>{prose()}<p>{prose()}</p>", f"<p>{words(1, 4)}.</p>", f"<h2>{words(1, 6)}</h2><p>{prose()}</p>",
                f"<p><b>{prose()}<br><p>{prose()}</p>", f"<ul><li>{prose(1, 2)}</li><li>{words(1, 5)}</li></ul>",
                f"<ol><li>{words(2, 8)}<li>{words(2, 8)}</ol>", f"<blockquote><p>{prose()}</p></blockquote>", f"<pre>{words(3, 9)}</pre>",
                f"<table><tr><td>{words(1, 3)}</td><td>{words(1, 3)}</td></tr></table>", f"<div>{prose()}</div>",
                f"<section><h3>{words(1, 4)}</h3><p>{prose()}</p></section>", f"<figure><figcaption>{words(2, 8)}.</figcaption></figure>",
                f"<p>{prose()} <a href='/x'>{words(1, 3)}</a> {prose()}</p>"))
            if rng.random() < 0.15:
                parts.append(one(
                    f'<div class="{one("ad", "advert", "promo")}" data-keep="0">{prose(1, 2)}</div>',
                    f'<aside data-keep="0"><p>{prose(1, 2)}</p></aside>', f'<div class="share social" data-keep="0">{words(1, 4)}</div>',
                    f'<aside class="related" data-keep="0"><ul>{links(3)}</ul></aside>',
                    f'<form data-keep="0"><p>{words(2, 6)}</p><input name="q"></form>',
                    f'<div class="newsletter" data-keep="0"><p>{prose(1, 1)}</p></div>'))
        return "".join(parts)

    def around(late: bool) -> str:
        comment = f'<div class="comment" data-keep="0"><p>{prose(1, 3)}</p></div>'
        options = [
            f"<nav><ul>{links(rng.randint(2, 8))}</ul></nav>", f'<div class="{one("menu", "navbar", "breadcrumbs")}"><ul>{links(4)}</ul></div>',
            f'<div class="ad">{prose(1, 2)}</div>', f'<div id="{one("banner", "sponsored")}"><p>{prose(1, 3)}</p></div>',
            f'<div class="{one("cookie-notice", "alert", "consent popup", "notice")}"><p>{prose(1, 3)}</p></div>',
            f"<aside><h3>{words(1, 3)}</h3><p>{prose(1, 3)}</p></aside>", f'<div class="sidebar"><p>{prose(1, 3)}</p><ul>{links(3)}</ul></div>',
            f'<form action="/s"><p>{words(1, 6)}</p><input name="q"></form>', f'<div class="newsletter"><p>{prose(1, 2)}</p></div>',
            f"<script>var t='<p>{words(2, 5)}</p>';</script>"]
        late_options = [
            f'<section class="{one("comments", "discussion", "replies")}"><h2>{words(1, 2)}</h2>{comment * rng.randint(1, 4)}</section>',
            f'<div id="comments"><ul><li>{prose(1, 3)}</li><li>{prose(1, 2)}</li></ul></div>',
            f"<footer>&copy; {words(1, 3)} &middot; {prose(1, 3)}</footer>", f'<div class="footer"><p>{prose(1, 2)}</p></div>',
            f'<article class="comment"><p>{prose(1, 3)}</p></article>', f'<div class="related"><ul>{links(4)}</ul></div>']
        early_options = [f"<header><h2>{words(1, 4)}</h2><p>{words(2, 6)}</p></header>", f'<div id="header">{words(1, 5)}</div>',
                         f'<div class="masthead"><h1>{words(1, 3)}</h1></div>']
        return one(*options, *(late_options * 2 if late else early_options))

    pages = []
    for _ in range(n):
        tag, name = rng.choice([("article", ""), ("article", ""), ("main", ""), ("div", ' class="content"'), ("div", ' id="main-content"'),
                                ("div", ' class="post-body"'), ("section", ' class="entry"'), ("article", ' class="post"')])
        heart = f'<{tag}{name} data-keep="1">{inner()}</{tag}>'
        if rng.random() < 0.25:
            heart = f'<div class="{one("wrapper", "container", "row", "page")}">{heart}</div>'
        before = "".join(around(False) for _ in range(rng.randint(0, 4)))
        after = "".join(around(True) for _ in range(rng.randint(0, 5)))
        pages.append(f'<html><head><title>{words(1, 4)}</title></head><body data-keep="0">{before}{heart}{after}</body></html>')

    def off(k: int, late: bool) -> str:
        """Surroundings that are marked as such wherever they stand."""
        return "".join(re.sub(r"^<([a-z]+)", r'<\1 data-keep="0"', around(late)) for _ in range(rng.randint(0, k)))

    def unnamed() -> str:
        return one("", "", f' class="{rng.choice(vocabulary)}"', f' id="{rng.choice(vocabulary)}-{rng.randint(1, 9)}"', ' class="lead"',
                   ' class="col-8"', ' class="wrap inner"')

    for _ in range(n):
        body = inner()
        form = rng.randrange(6)
        if form <= 1:  # blocks right below the body
            page = f'<html><body data-keep="1">{off(3, False)}{body}{off(4, True)}</body></html>'
        elif form == 2:  # a container of no known name
            page = f'<html><body data-keep="0">{off(3, False)}<div{unnamed()} data-keep="1">{body}</div>{off(4, True)}</body></html>'
        elif form == 3:
            page = f'<div{unnamed()} data-keep="1">{body}</div>'
        elif form == 4:  # a table as layout
            menu = one("", f'<td data-keep="0"><ul>{links(4)}</ul></td>', f'<td data-keep="0"><a href="/">{words(1, 2)}</a><br><a href="/b">{words(1, 2)}</a></td>')
            page = f'<html><body data-keep="0">{off(2, False)}<table><tr>{menu}<td data-keep="1">{body}</td></tr></table>{off(2, True)}</body></html>'
        else:
            page = f'<html><body data-keep="1"><center{unnamed()}>{body}</center></body></html>'
        pages.append(page)
    return pages


def seed_trees() -> list[Tree]:
    """The labelled seed layouts, and texts without tags, which are content as a whole."""
    pages = seed_pages()
    trees = [parse(p, labelled=True) for p in pages]
    for t in trees[-SEEDS // 10:]:
        plain = parse(". ".join(text for _, text, _ in t.segments))
        plain.label[0] = "1"
        trees.append(plain)
    return trees


def sample(pages: DataFrame, most: int = SAMPLE_PAGES) -> list[Tree]:
    """Whole trees, without texts, of a bounded number of the table's pages that label themselves."""
    source = pages.select(F.col("html").cast("string").alias("html")).where("html is not null")
    total = pages.count()
    draw = F.pmod(F.xxhash64("html", F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = source.where(draw < min(1.0, most / total) if total else F.lit(False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle
        import zlib

        for batch in slices(batches, "html"):
            key, out = [], []
            for page in batch.column("html").to_pylist():
                tree = parse(page)
                if labels(tree) is not None:
                    tree.measures, tree.segments = tree.measured(), []
                    key.append(zlib.crc32(page.encode("utf-8", "replace")))
                    out.append(pickle.dumps([(getattr(tree, s)) for s in Tree.__slots__]))
            yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(out, pa.binary())], names=["h", "tree"])

    import pickle

    trees = []
    for r in chosen.mapInArrow(run, "h long, tree binary").orderBy("h", "tree").limit(most).collect():
        tree = Tree()
        for name, value in zip(Tree.__slots__, pickle.loads(bytes(r["tree"]))):
            setattr(tree, name, value)
        trees.append(tree)
    return trees


def train(pages: DataFrame, most: int = SAMPLE_PAGES) -> Model:
    """Model of the seed layouts and a bounded sample of the table's pages (of each at most its parsed tree reaches the driver)."""
    return fit(seed_trees() + sample(pages, most))


def extract(texts: list, model: Model) -> list[str]:
    """Main text of each page."""
    trees = [parse(t) for t in texts]
    if not trees:
        return []
    forest = Forest(trees)
    p, _, _ = forest.marginals(model.weights, model.pair)
    return ["\n".join(text for node, text, _ in t.segments if p[s + node] >= 0.5) for t, s in zip(trees, forest.starts)]


FIELDS = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]


def html_extract(pages: DataFrame, model: Model) -> DataFrame:
    """``pages`` with text and n_chars."""

    def start() -> Callable:
        def run(texts: list) -> dict:
            out: list[str] = []
            for i in range(0, len(texts), 256):
                out += extract(texts[i:i + 256], model)
            return {"text": out, "n_chars": [len(t) for t in out]}

        return run

    return add_columns(pages, "html", T.StructType(FIELDS), start)
