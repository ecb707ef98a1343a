"""Links of HTML pages."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import quote, urljoin, urlsplit, urlunsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import urls

_PORTS = {"http": 80, "https": 443}


def absolute(base: str, href: str) -> str | None:
    """href against base in normal form, without fragment; null unless http(s)."""
    try:
        parts = urlsplit(urljoin(base, href.strip().replace("\\", "/")))
        if parts.scheme not in _PORTS or not parts.hostname:
            return None
        name = parts.hostname.encode("idna").decode() if not parts.hostname.isascii() else parts.hostname
        if ":" in name:
            name = f"[{name}]"
        if parts.port and parts.port != _PORTS[parts.scheme]:
            name += f":{parts.port}"
        return urlunsplit((parts.scheme, name, quote(parts.path or "/", safe="/%:@!$&'()*+,;=~[]|^"), quote(parts.query, safe="=&%/?:@!$()*+,;~[]|^{}`'\\"), ""))
    except (ValueError, UnicodeError):
        return None


_NAMED = re.compile(r"&([A-Za-z][A-Za-z0-9]*)(;|(?==)|)")


def _reference(m: re.Match) -> str:
    """A named reference as attributes read it: one without a semicolon before a letter, digit or = is plain text."""
    known = f"{m[1]};" in html5 if m[2] else m[1] in html5 and m.string[m.end() : m.end() + 1] != "="
    return m[0] if known else "&amp;" + m[0][1:]


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.found += [v for k, v in attrs if k == "href" and v]

    handle_startendtag = handle_starttag


def links_of(html: str | None, base: str | None) -> list[str]:
    """Every link in order of first appearance."""
    if not html or not base:
        return []
    p = _Anchors()
    try:
        p.feed(_NAMED.sub(_reference, html))
        p.close()
    except AssertionError:  # the parser's word for markup that it can't go on with; links so far count
        pass
    return list(dict.fromkeys(u for h in p.found if not h.strip().lower().startswith(("mailto:", "tel:", "javascript:")) and (u := absolute(base, h))))


@F.pandas_udf(T.ArrayType(T.StringType()))
def discover_links(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for html, base in batches:
        yield pd.Series([links_of(h, b) for h, b in zip(html, base)])


def link_edges(pages: DataFrame, html: str = "html", url: str = "url", domain: Column | None = None) -> DataFrame:
    """(src, dst, pos, in_domain, trap), once for each src and dst, however many rows a URL has; pos is the first place on any of them. domain: the page's own host if None."""
    d = urls.host(F.col("src")) if domain is None else domain
    edges = pages.select(F.col(url).alias("src"), F.posexplode(discover_links(F.col(html), F.col(url))).alias("pos", "dst"))
    edges = edges.groupBy("src", "dst").agg(F.min("pos").alias("pos"))
    return edges.select("src", "dst", "pos", urls.in_domain(F.col("dst"), d).alias("in_domain"), urls.is_trap(F.col("dst")).alias("trap"))


def followable(edges: DataFrame) -> DataFrame:
    return edges.where("in_domain and not trap")
