"""HTML extraction by composite text density.

Every element gets its characters C, tags T, link characters LC and link tags LT (of its subtree; T, LC
and LT count 1 where they are 0), and the composite density

    C / T * log_b(C / LC * T / LT),  b = ln(C / (C - LC) * LC + LC_body / C_body * C + e).

The element with the greatest sum of its children's densities is the main one; the least density on the
path from it up to body is the threshold. From body down, in every element that reaches the threshold the
subtree with the greatest density sum is content.

Where the base is 1 (no links in the page) the logarithm is replaced by 1 + ln(C * T).

Defined results: null and empty pages give empty text; a page without elements gives its text; a page
whose body has no element children gives the body's text; ties go to the first element in document order;
unclosed and stray tags are repaired the way browsers do for p, li, table cells and options; script,
style, template, textarea, noscript, iframe, svg and comments never count; a page in which no element is
content gives all its text. Time is linear in the page, however its tags are nested or left open. Rows that repeat give repeated results, null ids stay null. Only the id, url
and html columns are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from ._batch import chunks

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>""", re.S)
_RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "svg"}
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in _RAW}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set("address article aside blockquote body br caption dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table tbody td tfoot th thead tr ul".split())
_CLOSES = {t: {"p"} for t in "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()}
_CLOSES |= {"li": {"li", "p"}, "dd": {"dd", "dt", "p"}, "dt": {"dd", "dt", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"tr", "td", "th", "p"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}}
#: Elements that keep an implied end tag from closing what is outside them.
_FENCE = {"table", "ul", "ol", "dl", "div", "article", "section", "body", "html", "main", "nav", "td", "th", "blockquote"}
#: Elements whose start closes every open one of its list, not only the innermost.
_MANY = {"li", "dd", "dt", "tr", "td", "th", "tbody", "tfoot"}
#: An end tag reaches out of a cell or table only if it is one of a row or table.
_CELLS, _ROWS = {"td", "th", "table"}, {"table", "tr", "tbody"}
_HEAD = {"head", "title", "meta", "link", "base"}
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("best", "children", "content", "density", "end", "link_chars", "link_tags", "n", "parent", "parts", "sum", "tag", "tags", "top")

    def __init__(self, tag: str, parent: int):
        self.tag, self.parent, self.children, self.parts = tag, parent, [], []
        self.n = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.sum = self.top = 0.0
        self.content, self.best = False, -1


class _Open:
    """Open elements, with the places of each tag, so that finding the innermost of a kind needs no walk."""

    def __init__(self):
        self.stack: list[int] = [0]
        self.tags: list[str] = ["body"]
        self.places: dict[str, list[int]] = {}

    def push(self, node: int, tag: str) -> None:
        self.places.setdefault(tag, []).append(len(self.stack))
        self.stack.append(node)
        self.tags.append(tag)

    def cut(self, k: int) -> None:
        """Closes everything from place k on."""
        while len(self.stack) > k:
            self.stack.pop()
            self.places[self.tags.pop()].pop()

    def last(self, tags) -> int:
        """Place of the innermost element with one of the tags, 0 if there is none."""
        return max((p[-1] for t in tags if (p := self.places.get(t))), default=0)


def parse(html: str) -> list[Node]:
    """Elements in document order; 0 is body. A node's parts are strings and the indices of its children."""
    nodes, opened, at, in_head = [Node("body", -1)], _Open(), 0, False
    stack = opened.stack
    # behind the last > nothing can be markup but a comment that never ends; so unclosed tags there are not tried one by one
    last = html.rfind(">") + 1
    while m := _TOKEN.search(html, at, last):
        if m.start() > at and not in_head and (s := _SPACE.sub(" ", unescape(html[at : m.start()]))) and s != " ":
            nodes[stack[-1]].parts.append(s)
        elif m.start() > at and not in_head:
            nodes[stack[-1]].parts.append(" ")
        at = m.end()
        if not m[2]:
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(html)
            continue
        tag = m[2].lower()
        if tag == "head":
            in_head = not m[1]
            continue
        if tag == "body" or (in_head and tag not in _HEAD and tag not in _RAW):
            in_head = False
        if tag in ("html", "body") or in_head and tag not in _RAW:
            continue
        if m[1]:
            k = opened.last((tag,))
            if k and (tag in _ROWS or k >= opened.last(_CELLS)):
                opened.cut(k)
            continue
        if tag in _RAW:
            # what is inside is no markup: on to its own end tag, or all the rest if there is none
            if not m[3].endswith("/"):
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else len(html)
            continue
        closes = _CLOSES.get(tag)
        while closes and (k := opened.last(closes)) and k >= opened.last(_FENCE):
            opened.cut(k)
            if tag not in _MANY:
                break
        node = Node(tag, stack[-1])
        nodes.append(node)
        i = len(nodes) - 1
        nodes[node.parent].children.append(i)
        nodes[node.parent].parts.append(i)
        if tag not in _VOID and not m[3].endswith("/"):
            opened.push(i, tag)
    rest = html[at:].partition("<!--")[0]
    if rest and not in_head:
        nodes[stack[-1]].parts.append(_SPACE.sub(" ", unescape(rest)))
    return nodes


def density(c: int, t: int, lc: int, lt: int, lc_body: int, c_body: int) -> float:
    """Composite text density of one element."""
    if not c:
        return 0.0
    t, lt1, lc1 = t or 1, lt or 1, lc or 1
    base = math.log(c / ((c - lc) or 1) * lc + (lc_body / c_body if c_body else 0) * c + math.e)
    base = math.log(base) if base > 1 else 0.0
    inner = c / lc1 * t / lt1
    return c / t * (math.log(inner) / base if base > 1e-9 else math.log(inner) / 1e-9 if lc else math.log(inner) + 1)


def score(nodes: list[Node]) -> float:
    """Fills the nodes' counts, densities, sums and content marks; gives the threshold."""
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        x.end = nodes[x.children[-1]].end if x.children else i + 1
        x.n += sum(len(p.strip()) for p in x.parts if isinstance(p, str))
        if x.tag == "a":
            x.link_chars, x.link_tags = x.n, x.link_tags + 1
        if x.parent >= 0:
            p = nodes[x.parent]
            p.n, p.tags, p.link_chars, p.link_tags = p.n + x.n, p.tags + x.tags + 1, p.link_chars + x.link_chars, p.link_tags + x.link_tags
    body = nodes[0]
    for x in nodes:
        x.density = density(x.n, x.tags, x.link_chars, x.link_tags, body.link_chars, body.n)
        if x.parent >= 0:
            nodes[x.parent].sum += x.density
    for i in range(len(nodes) - 1, -1, -1):
        x = nodes[i]
        x.top, x.best = x.sum, i
        for k in x.children:
            if nodes[k].top > x.top:
                x.top, x.best = nodes[k].top, nodes[k].best
    main = body.best
    threshold, i = body.density, main
    while i > 0:
        threshold, i = min(threshold, nodes[i].density), nodes[i].parent
    todo = [0]
    while todo:
        i = todo.pop()
        x = nodes[i]
        if x.density < threshold or x.content:
            continue
        # marked ranges are whole subtrees: two of them are the same or apart, and none is gone over twice
        if (x.top > 0 or not body.children) and not nodes[x.best].content:
            for k in range(x.best, nodes[x.best].end):
                nodes[k].content = True
        todo += x.children
    if not any(x.content for x in nodes):
        for x in nodes:
            x.content = True
    return threshold


def render(nodes: list[Node]) -> str:
    """Text of the marked elements, one line for each block."""
    out: list[str] = []
    todo: list[tuple[int, int | str]] = [(0, 0)]
    while todo:
        owner, part = todo.pop()
        if isinstance(part, str):
            if owner < 0 or nodes[owner].content:
                out.append(part)
            continue
        x = nodes[part]
        mark = [(-1, "\n")] if x.tag in _BLOCK else []
        todo += mark
        todo += [(part, p) for p in reversed(x.parts)]
        todo += mark
    lines = (_SPACE.sub(" ", s).strip() for s in "".join(out).split("\n"))
    return "\n".join(s for s in lines if s)


def extract(html: str | None) -> tuple[str, int, float]:
    """(text, elements, threshold) of a page."""
    if not html:
        return "", 0, 0.0
    nodes = parse(html)
    t = score(nodes)
    return render(nodes), len(nodes), t


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_nodes, threshold) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, _ in chunks(batches, "html"):
            done = [extract(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([d[0] for d in done], pa.string()), pa.array([d[1] for d in done], pa.int32()), pa.array([round(d[2], 6) for d in done], pa.float64())],
                names=["page_id", "url", "text", "n_nodes", "threshold"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_nodes int, threshold double")
