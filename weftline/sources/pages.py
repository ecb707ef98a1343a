"""HTML and PDF bodies to documents: title, description, markdown, plain text and language.

The HTML extractor keeps headings, paragraphs, lists, quotes, tables and preformatted text of the main part of a page, and favours
recall: the main element is the one with most text outside links; if it has under a third of the page's text, the
whole body counts. Navigation, header, footer, aside, forms and scripts are left out. PDF needs a function that turns bytes into
markdown, since no PDF library is assumed.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

from ..functions.language import guess

_SKIP = {"script", "style", "noscript", "template", "svg", "iframe", "form", "button", "select"}
_FRAME = {"nav", "header", "footer", "aside"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_MAIN = {"main", "article"}
_HEAD = {f"h{i}": "#" * i + " " for i in range(1, 7)}
_BREAK = {"p", "div", "section", "article", "main", "ul", "ol", "table", "tr", "blockquote", "pre", "dl", "dt", "dd", "figure", "figcaption", "hr", "br", *_HEAD}
_PLAIN = (
    # order matters: rules first, then what holds text, then marks, then spacing
    (re.compile(r"^\s*\|?(?:\s*[-*_:]{3,}\s*\|?)+\s*$", re.M), ""),
    (re.compile(r"!\[[^\]]*\]\([^)]*\)"), ""),
    (re.compile(r"\[([^\]]*)\]\([^)]*\)"), r"\1"),
    (re.compile(r"^\s{0,3}#{1,6}\s+", re.M), ""),
    (re.compile(r"^\s{0,3}>\s?", re.M), ""),
    (re.compile(r"^\s*[-*+]\s+", re.M), ""),
    (re.compile(r"\*\*|\*|__|_|`"), ""),
    (re.compile(r"\|"), " "),
    (re.compile(r"[ \t]+"), " "),
    (re.compile(r"\n{3,}"), "\n\n"),
)


def plain(markdown: str) -> str:
    """As functions.text.markdown_to_text, for one string."""
    for pattern, to in _PLAIN:
        markdown = pattern.sub(to, markdown)
    return markdown.strip()


class _Page(HTMLParser):
    """Collects metadata, and markdown by whether it lies in a main element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.meta, self.in_title = "", {}, False
        self.open: list[str] = []
        self.skip = self.frame = self.main = self.link = self.pre = 0
        self.parts: list[tuple[bool, str]] = []
        self.cells = 0

    def put(self, s: str) -> None:
        self.parts.append((self.main > 0, s))

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            name = (a.get("name") or a.get("property") or "").lower()
            if name and a.get("content"):
                self.meta.setdefault(name, a["content"].strip())
            return
        if tag == "title" and not self.title and "svg" not in self.open:
            self.in_title = True
        if tag in _VOID:
            if tag in ("br", "hr"):
                self.put("\n")
            elif tag == "img" and a.get("alt") and not self.skip and not self.frame:
                self.put(f"![{a['alt']}]({a.get('src', '')})")
            return
        self.open.append(tag)
        self.count(tag, 1)
        if self.skip or self.frame:
            return
        if tag in _BREAK:
            self.put("\n\n" if tag != "tr" else "\n")
        if tag in _HEAD:
            self.put(_HEAD[tag])
        elif tag == "li":
            self.put("\n- ")
        elif tag == "blockquote":
            self.put("> ")
        elif tag in ("td", "th"):
            self.put("| ")
        elif tag == "a":
            self.link += 1
            self.put("[")
            self.href = a.get("href", "")

    def count(self, tag: str, by: int) -> None:
        self.skip += by * (tag in _SKIP)
        self.frame += by * (tag in _FRAME)
        self.main += by * (tag in _MAIN)
        self.pre += by * (tag == "pre")

    def handle_endtag(self, tag):
        if tag == "title":
            self.in_title = False
        if tag not in self.open:
            return
        while self.open:
            last = self.open.pop()
            inside = not (self.skip or self.frame)
            self.count(last, -1)
            if inside and last == "a" and self.link:
                self.link -= 1
                self.put(f"]({getattr(self, 'href', '')})")
            if inside and last in _BREAK:
                self.put(" |" if last == "tr" else "\n\n")
            if last == tag:
                break

    def handle_data(self, data):
        if self.in_title:
            self.title += data
        elif not self.skip and not self.frame and "head" not in self.open:
            self.put(data if self.pre else re.sub(r"\s+", " ", data))


def _joined(parts) -> str:
    text = re.sub(r"\[\s*\]\([^)]*\)", "", "".join(parts))
    lines = [line.strip() for line in text.split("\n")]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip()


def extract_html(data: bytes | str | None) -> dict | None:
    """Document of a page, or None without text."""
    if not data:
        return None
    page = _Page()
    page.feed(data.decode("utf-8", "replace") if isinstance(data, bytes) else data)
    page.close()
    whole, main = _joined(s for _, s in page.parts), _joined(s for inside, s in page.parts if inside)
    markdown = main if 3 * len(main) >= len(whole) else whole
    text = plain(markdown)
    if not text:
        return None
    heading = re.search(r"^# (.+)$", markdown, re.M)
    title = page.meta.get("og:title") or " ".join(page.title.split()) or (heading[1].strip() if heading else None)
    known = {"author": "author", "date": "article:published_time", "description": "description", "sitename": "og:site_name"}
    meta = {k: page.meta.get(v) for k, v in known.items()}
    meta["description"] = meta["description"] or page.meta.get("og:description")
    return {"title": title or None, "text": text, "markdown": markdown, "lang": guess(text), "word_count": len(text.split()), "metadata": meta}


def extract_pdf(data: bytes, to_markdown: Callable[[bytes], str], embedded_title: Callable[[bytes], str | None] = lambda _: None) -> dict | None:
    """Document of a PDF by the functions given: title from the first heading of level 1, else the embedded one unless it is a placeholder."""
    markdown = (to_markdown(data) or "").strip()
    if not markdown:
        return None
    text = plain(markdown)
    heading = re.search(r"^# (.*)$", markdown, re.M)
    title = heading[1].strip() if heading else ""
    return {"title": title or usable_title(embedded_title(data)), "text": text, "markdown": markdown, "lang": guess(text), "word_count": len(text.split()), "metadata": {"extractor": "pdf"}}


def usable_title(raw: str | None) -> str | None:
    """As functions.text.clean_title, for one string."""
    t = (raw or "").strip()
    low = t.lower()
    junk = low in ("document1", "dokument1", "title", "unbenannt", "untitled") or re.match(r"microsoft (word|powerpoint|excel) -", low) or re.fullmatch(r"[\w .\-]+\.(pdf|docx?|pptx?|xlsx?)", low)
    return t if t and not junk else None
