"""Main text of web pages: content marginals of a tree-structured graphical model over the DOM."""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import small_batches

_NAME = r"[a-zA-Z][^\s/>]*"
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|</(?P<end>{_NAME})[^>]*(?:>|\Z)"
    # A quote starts a value behind an equals sign only; elsewhere it is a plain character, as in browsers.
    rf"|<(?P<start>{_NAME})(?P<rest>(?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*)(?:>|\Z)",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|itemprop|hidden|style|data-y|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z]+")
_SILENT = frozenset("script style template noscript svg math iframe object canvas textarea select option title head audio video map".split())
_RAW = {name: re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I) for name in "script style textarea title iframe noscript xmp".split()}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark output q s samp "
    "small span strike strong sub sup time tt u var wbr img br".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr main menu nav ol p pre section table ul".split()
)
_CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPES = frozenset("ul ol dl table tr body html article section div".split())
ROOT, TEXT = "#root", "#text"
#: The most that a text's length or last character weighs, as a log ratio.
WEAK = 1.5
#: Children of a node whose messages count in full.
MOST_HEARD = 16
_CLASS_STOP = frozenset(("", "js", "x"))


@dataclass
class Nodes:
    """The block elements and text runs of some pages, parents before children."""

    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    marks: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str | None] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    page: list[int] = field(default_factory=list)

    def add(self, parent: int, tag: str, marks: tuple[str, ...], page: int, label: int = -1) -> int:
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.tag.append(tag)
        self.marks.append(marks)
        self.text.append(None)
        self.linked.append(0)
        self.label.append(label)
        self.page.append(page)
        return len(self.parent) - 1


def _marks(rest: str) -> tuple[tuple[str, ...], int]:
    """Parts of class, id and role, and a training label if there is one."""
    found: set[str] = set()
    label = -1
    if "=" in rest or "hidden" in rest:
        for name, *values in _ATTRIBUTE.findall(rest):
            name, value = name.lower(), next((v for v in values if v), "")
            if name == "data-y":
                label = int(value)
            elif name == "style":
                if "display:none" in value.replace(" ", "").lower():
                    found.add("hidden")
            elif name != "hidden":
                found.update(_PART.findall(value.lower()))
        if re.search(r"(?:^|\s)hidden(?:\s|$|=|/)", rest):
            found.add("hidden")
    return tuple(sorted(found - _CLASS_STOP)), label


def parse(source: str, page: int, nodes: Nodes) -> None:
    """Add a page's nodes. Wrong nesting is mended as browsers do for paragraphs, items and cells; ends without a start count for nothing."""
    root = nodes.add(-1, ROOT, (), page)
    open_: list[tuple[str, int]] = [(ROOT, root)]  # elements, with the node that their text goes to
    parts: list[str] = []
    linked = links = silent = 0
    position = 0
    lower_end = len(source)
    # Where elements of a name stand in open_, and those that are no inline ones.
    places: defaultdict[str, list[int]] = defaultdict(list)
    blocks = [0]

    def push(name: str, node: int) -> None:
        places[name].append(len(open_))
        if name not in _INLINE:
            blocks.append(len(open_))
        open_.append((name, node))

    def last(name: str) -> int:
        return places[name][-1] if places[name] else 0

    def flush() -> None:
        nonlocal linked
        if parts:
            raw = "".join(parts)
            text = " ".join((entities.unescape(raw) if "&" in raw else raw).split())
            if text:
                at = nodes.add(open_[-1][1], TEXT, (), page)
                nodes.text[at] = text
                nodes.linked[at] = min(linked, len(text))
            parts.clear()
        linked = 0

    def close(at: int) -> None:
        nonlocal silent, links
        for name, _ in open_[at:]:
            silent -= name in _SILENT
            links -= name == "a"
            places[name].pop()
        if blocks[-1] >= at:
            flush()
        while blocks[-1] >= at:
            blocks.pop()
        del open_[at:]

    while position < lower_end:
        found = _TOKEN.search(source, position)
        until = found.start() if found else lower_end
        if until > position and not silent:
            part = source[position:until]
            parts.append(part)
            if links:
                linked += len(part)
        if not found:
            break
        position = found.end()
        kind = found.lastgroup
        if kind == "cdata":
            if not silent:
                parts.append(found["cdata"])
        elif found["end"]:
            name = found["end"].lower()
            if name == "br":
                parts.append(" ")
            elif name == "p" and not last("p"):
                flush()
            elif last(name) and (name not in _INLINE or last(name) > blocks[-1]):
                close(last(name))
        elif found["start"]:
            name = found["start"].lower()
            if name in _VOID:
                if name == "hr":
                    flush()
                elif name in ("br", "img", "input"):
                    parts.append(" ")
                continue
            if name in _RAW:
                end = _RAW[name].search(source, position)
                position = end.end() if end else lower_end
                continue
            if name in _INLINE:
                if name == "a":
                    links += 1
                push(name, open_[-1][1])
                continue
            if name in _CLOSES_P and last("p") and last("p") == blocks[-1]:
                close(blocks[-1])
            if name in _CLOSED_BY:
                at = max(map(last, _CLOSED_BY[name]))
                if at > max(map(last, _SCOPES)):
                    close(at)
            flush()
            rest = found["rest"]
            if name in _SILENT:
                silent += 1
                push(name, open_[-1][1])
            else:
                marks, label = _marks(rest) if rest else ((), -1)
                push(name, nodes.add(open_[-1][1], name, marks, page, label))
    flush()


@dataclass
class Shape:
    """What carries over to sites whose names nobody has seen: by node, its subtree and its place on the page."""

    size: list[int]  # characters of text below
    linked: list[int]  # those in links
    side: list[str]  # of the page's main element: in it, above it (its ancestors), beside it; or none

    @classmethod
    def of(cls, nodes: Nodes) -> Shape:
        n = len(nodes.parent)
        size, linked = [len(t) if t is not None else 0 for t in nodes.text], list(nodes.linked)
        for at in range(n - 1, -1, -1):  # children come after their parents
            above = nodes.parent[at]
            if above >= 0:
                size[above] += size[at]
                linked[above] += linked[at]
        main: dict[int, int] = {}
        for at in range(n):
            if nodes.tag[at] in ("main", "article") and size[at] > size[main.get(nodes.page[at], at)] - (nodes.page[at] not in main):
                main[nodes.page[at]] = at
        side = ["beside" if page in main else "none" for page in nodes.page]
        for at in main.values():
            above = nodes.parent[at]
            while above >= 0:
                side[above] = "above"
                above = nodes.parent[above]
            side[at] = "in"
        for at in range(n):
            if nodes.parent[at] >= 0 and side[nodes.parent[at]] == "in":
                side[at] = "in"
        return cls(size, linked, side)


def features(nodes: Nodes, at: int, shape: Shape) -> Iterator[str]:
    """What a node's potential looks at: its names, the length and links of its text or subtree, its place."""
    text = nodes.text[at]
    if text is None:
        for mark in nodes.marks[at]:
            yield f"mark {mark}"
        if nodes.parent[at] >= 0:
            yield f"subtree links {min(4, 5 * shape.linked[at] // max(shape.size[at], 1))}"
            yield f"side {shape.side[at]}"
        return
    yield f"length {min(len(text).bit_length(), 10)}"
    yield f"links {min(4, 5 * nodes.linked[at] // max(len(text), 1))}"
    yield f"end {text[-1] if text[-1] in '.!?:,;' else 'x'}"
    yield "symbol" if text[0] in "©®" else "plain"


@dataclass
class TreeModel:
    """Log potentials: one for each parent-child pair of labels and tags, and one for each feature and label."""

    edges: dict[tuple[str, str], np.ndarray]
    by_child: dict[str, np.ndarray]
    any_edge: np.ndarray
    unary: dict[str, np.ndarray]
    root: np.ndarray

    def edge(self, parent: str, child: str) -> np.ndarray:
        """Rows: the parent's label; columns: the child's."""
        found = self.edges.get((parent, child))
        if found is None:
            found = self.by_child.get(child, self.any_edge)
        return found

    def marginals(self, nodes: Nodes) -> np.ndarray:
        """Probability of content for each node, by sum-product messages up and then down, level by level.

        Siblings say much the same, and a small lean of each would add up to a certainty: above
        ``MOST_HEARD`` children, a parent takes their messages to a power that makes them
        count as that many.
        """
        n = len(nodes.parent)
        parent, depth = np.array(nodes.parent), np.array(nodes.depth)
        kinds: dict[tuple[str, str], int] = {}
        tables: list[np.ndarray] = []
        kind = np.zeros(n, dtype=np.int64)
        unary = np.zeros((n, 2))
        shape = Shape.of(nodes)
        for at in range(n):
            above = nodes.parent[at]
            if above >= 0:
                pair = (nodes.tag[above], nodes.tag[at])
                if pair not in kinds:
                    kinds[pair] = len(tables)
                    tables.append(self.edge(*pair))
                kind[at] = kinds[pair]
            else:
                unary[at] += self.root
            for name in features(nodes, at, shape):
                found = self.unary.get(name)
                if found is not None:
                    unary[at] += found
        potential = np.exp(np.array(tables) if tables else np.zeros((1, 2, 2)))
        inside = unary  # becomes the unary potential plus the children's messages
        upward = np.zeros((n, 2))
        levels = np.split(np.argsort(depth, kind="stable"), np.cumsum(np.bincount(depth))[:-1]) if n else []
        children = np.bincount(parent[parent >= 0], minlength=n)
        heard = np.minimum(1.0, MOST_HEARD / np.maximum(children[parent], 1))[:, None]
        for rows in reversed(levels[1:]):
            peak = inside[rows].max(axis=1, keepdims=True)
            sent = np.einsum("npc,nc->np", potential[kind[rows]], np.exp(inside[rows] - peak))
            upward[rows] = (np.log(sent) + peak) * heard[rows]
            np.add.at(inside, parent[rows], upward[rows])
        whole = np.zeros((n, 2))
        for d, rows in enumerate(levels):
            if d == 0:
                whole[rows] = inside[rows]
            else:
                outside = whole[parent[rows]] - upward[rows]
                peak = outside.max(axis=1, keepdims=True)
                got = np.einsum("npc,np->nc", potential[kind[rows]], np.exp(outside - peak))
                whole[rows] = inside[rows] + np.log(got)
            whole[rows] -= whole[rows].max(axis=1, keepdims=True)
        shares = np.exp(whole)
        return shares[:, 1] / shares.sum(axis=1)


def train(pages: list[str], smoothing: float = 0.3) -> TreeModel:
    """Learn the potentials from pages whose elements carry ``data-y`` (1 content, 0 not).

    An element without a label has its parent's; the root's is content.
    """
    nodes = Nodes()
    for number, source in enumerate(pages):
        parse(source, number, nodes)
    edges = defaultdict(lambda: np.full((2, 2), smoothing))
    by_child = defaultdict(lambda: np.full((2, 2), smoothing))
    any_edge = np.ones((2, 2))
    unary = defaultdict(lambda: np.full(2, smoothing))
    totals = np.full(2, 2 * smoothing)
    shape = Shape.of(nodes)
    for at, above in enumerate(nodes.parent):
        if nodes.label[at] < 0:
            nodes.label[at] = nodes.label[above] if above >= 0 else 1
        y = nodes.label[at]
        if above >= 0:
            for counts in (edges[nodes.tag[above], nodes.tag[at]], by_child[nodes.tag[at]], any_edge):
                counts[nodes.label[above], y] += 1
        totals[y] += 1
        for name in features(nodes, at, shape):
            unary[name][y] += 1
    to_log = lambda counts: np.log(counts / counts.sum(axis=1, keepdims=True))
    # An edge's counts lean on those of the child's tag.
    leaned = {pair: to_log(counts + by_child[pair[1]] / by_child[pair[1]].sum(axis=1, keepdims=True)) for pair, counts in edges.items()}
    ratios = {name: np.log(counts / totals) for name, counts in unary.items()}
    for name, ratio in ratios.items():
        if name.startswith(("length ", "end ")):  # how long a text is says little, however often it was so
            ratio[1] = ratio[0] + np.clip(ratio[1] - ratio[0], -WEAK, WEAK)
    return TreeModel(leaned, {tag: to_log(c) for tag, c in by_child.items()}, to_log(any_edge), ratios, np.log([0.01, 0.99]))


_SENTENCE = "The committee met on the second day and agreed, after a long debate, to publish its findings in full. "
_LINKS = "".join(f'<li><a href="/{k}">Section {k}</a></li>' for k in range(6))


def labelled_pages() -> list[str]:
    """Small labelled pages: each layout of an article inside each kind of page furniture."""
    long, short = _SENTENCE * 3, "Fourth day."
    bodies = [
        f"<h1>A new report</h1><p><b>{short}<p>{long}</p><p>{short}</p><p>{long}</p>",
        f"<header><h1>Heading of it</h1></header><p>{long}</p><h2>Part two</h2><p>{short}</p><ul><li>{_SENTENCE}</li><li>{short}</li></ul>",
        f"<h1>Title</h1><h2>Below</h2><blockquote><p>{long}</p></blockquote><pre>x = 1</pre><ol><li>{short}</li></ol><figure><figcaption>{short}</figcaption></figure>",
        f"<h1>Figures</h1><table><tr><th>Year</th><th>Count</th></tr><tr><td>One</td><td>12</td></tr></table><p>{long}<a href='/x'>the source</a></p>",
        f"<section><h2>Start</h2><p>{long}</p><div><p>{short}</p></div></section><section><h3>End</h3><p>{_SENTENCE}</p><dl><dt>Term</dt><dd>{short}</dd></dl></section>",
    ]
    wraps = [
        "<article>{}</article>",
        "<main><article>{}</article></main>",
        '<main id="content">{}</main>',
        '<div class="content article-body">{}</div>',
        '<div class="post entry-content"><article>{}</article></div>',
        '<div id="main"><div class="story text">{}</div></div>',
        "<div>{}</div>",
        "{}",
        "<div><div>{}</div></div>",
    ]
    noise = '<div class="{}" data-y="0"><p>{}</p></div>'
    before = [
        f'<nav data-y="0"><ul>{_LINKS}</ul></nav><div class="ad" data-y="0">{_SENTENCE}</div>',
        f'<header data-y="0"><a href="/">Home</a><h1>Site name</h1><nav><ul>{_LINKS}</ul></nav></header>',
        f'<div class="menu navbar" data-y="0"><ul>{_LINKS}</ul></div>' + noise.format("cookie-notice banner consent", _SENTENCE),
        f'<div id="header" class="top masthead" data-y="0"><p>Site</p></div><div class="breadcrumb" data-y="0">{_LINKS}</div>',
        f'<div class="sponsored advert promo" data-y="0"><p>{_SENTENCE}</p></div><div data-y="0" role="navigation" class="nav">{_LINKS}</div>',
        f'<aside class="notice" data-y="0"><p>{_SENTENCE}</p></aside><div class="alert gdpr popup modal" data-y="0"><p>{_SENTENCE}</p></div>',
    ]
    after = [
        f'<footer data-y="0">&copy; example.org &middot; {_SENTENCE}</footer>',
        f'<aside class="sidebar" data-y="0"><h3>Related</h3><ul>{_LINKS}</ul><p>{_SENTENCE}</p></aside><footer data-y="0"><p>{_SENTENCE}</p></footer>',
        f'<section class="comments" id="comments" data-y="0"><h2>Comments</h2><div class="comment"><p>{long}</p></div><article class="comment"><p>{_SENTENCE}</p></article></section>',
        f'<form class="newsletter subscribe" data-y="0"><p>{_SENTENCE}</p><label>Mail</label><button>Send</button></form><div id="footer" data-y="0"><p>{_SENTENCE}</p></div>',
        f'<ol class="comment-list replies" data-y="0"><li><p>{long}</p></li></ol><div class="share social" data-y="0"><button>Share</button></div>',
        noise.format("sidebar widget related", _SENTENCE) + noise.format("footer copyright legal", long) + noise.format("ads ad-banner advertisement", short),
        f'<div class="reader-comments discussion" data-y="0"><div class="reply"><p>{long}</p></div></div><dialog data-y="0"><p>{_SENTENCE}</p></dialog>',
    ]
    inner = ["", f'<div class="ad" data-y="0">{_SENTENCE}</div>', f'<aside data-y="0"><p>{_SENTENCE}</p></aside>', f'<nav data-y="0"><ul>{_LINKS}</ul></nav>', f'<footer data-y="0"><p>{short}</p></footer>', f'<form data-y="0"><p>{short}</p></form>']
    pages = []
    for k in range(len(bodies) * len(wraps) * len(after)):
        body = bodies[k % len(bodies)] + (inner[k // 3 % len(inner)] if k % 3 == 0 else "")
        furnished = before[(k // 2 + k) % len(before)] + wraps[k // len(bodies) % len(wraps)].format(body) + after[k % len(after)]
        pages.append(f"<html><head><title>T</title></head><body>{furnished}</body></html>")
    return pages


def content_of(model: TreeModel, sources: list[str], least: float = 0.5) -> list[str]:
    """The content blocks of each page in order, with an empty line between two."""
    nodes = Nodes()
    for number, source in enumerate(sources):
        parse(source, number, nodes)
    share = model.marginals(nodes)
    out: list[list[str]] = [[] for _ in sources]
    for at, text in enumerate(nodes.text):
        if text is not None and share[at] >= least:
            out[nodes.page[at]].append(text)
    return ["\n\n".join(blocks) for blocks in out]


def extract(pages: DataFrame, html: str = "html", text: str = "text", model: TreeModel | None = None) -> DataFrame:
    """``pages`` without ``html``, with ``text`` and ``n_chars``; columns of these names are replaced.

    Every page is read whole. A null or empty page, and one without content, has an empty
    text; plain text without markup is content. Blocks are joined by two line ends. All rows are kept and repeated pages give
    the same text. A block that the model takes for content is never cut.
    """
    rest = [name for name in pages.columns if name.lower() not in (html.lower(), text.lower(), "n_chars")]
    shared = pages.sparkSession.sparkContext.broadcast(model or train(labelled_pages()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "__html", 2 << 20):
            found = content_of(shared.value, [v.as_py() or "" for v in batch.column(batch.num_columns - 1)])
            sizes = pa.array([len(f) for f in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), sizes], names=[*rest, text, "n_chars"])

    chosen = pages.select(*(pages[c] for c in rest), F.col(html).alias("__html"))
    return chosen.mapInArrow(run, chosen.select(rest).schema.add(text, "string").add("n_chars", "long"))
