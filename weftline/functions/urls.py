"""URL columns. One regular expression splits a URL; malformed ones give empty parts instead of errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_URL = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
TRAP_LABELS = ("buchen", "moodle", "elearning")
TRAP_KEYS = ("forcedownload", "replytocom", "tx_solr")
#: Query keys that unfold a page's accordions, whatever extension made them.
TRAP_KEY_PATTERN = r"^tx_[a-z0-9]+content\[accordioncontainer\]"
TRAP_PATHS = ("/calendar/view.php",)
_BINARY = "7z avi bmp css doc docx eot gif gz ico jpeg jpg js json mov mp3 mp4 ogg png ppt pptx rar svg tar ttf wav webp woff woff2 xls xlsx zip".split()


def netloc(url: Column) -> Column:
    """Lower-case authority with its port."""
    return F.lower(F.regexp_extract(url, _URL, 1))


def host(url: Column) -> Column:
    """Lower-case host, without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(netloc(url), r"^.*@", ""), r":[0-9]*$", ""))


def path(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 2)


def query(url: Column) -> Column:
    return F.regexp_extract(url, _URL, 3)


def relative(url: Column) -> Column:
    """Path and query."""
    q = query(url)
    return F.concat(path(url), F.when(q != "", F.concat(F.lit("?"), q)).otherwise(""))


def query_pairs(url: Column) -> Column:
    return F.filter(F.split(query(url), "&"), lambda x: x != "")


def canonical_key(url: Column) -> Column:
    """Ordering of the URLs of one text: fewest query parameters, shortest, then by text."""
    return F.struct(F.size(query_pairs(url)).alias("n_params"), F.length(url).alias("length"), url.alias("url"))


def in_domain(url: Column, domain: Column) -> Column:
    h, d = host(url), F.lower(domain)
    return (h == d) | F.endswith(h, F.concat(F.lit("."), d))


def is_trap_host(url: Column) -> Column:
    label = F.split_part(host(url), F.lit("."), F.lit(1))
    return label.rlike("^(" + "|".join(TRAP_LABELS) + ")")


def is_trap(url: Column) -> Column:
    """Host, path or a decoded query key of a crawler trap."""
    hit = is_trap_host(url)
    for p in TRAP_PATHS:
        hit = hit | F.contains(path(url), F.lit(p))

    def trapped(pair: Column) -> Column:
        raw = F.split_part(pair, F.lit("="), F.lit(1))
        key = F.lower(F.coalesce(F.try_url_decode(raw), raw))
        out = key.rlike(TRAP_KEY_PATTERN)
        for k in TRAP_KEYS:
            out = out | F.startswith(key, F.lit(k))
        return out

    return hit | F.exists(query_pairs(url), trapped)


def mime_essence(content_type: Column) -> Column:
    return F.lower(F.trim(F.split_part(content_type, F.lit(";"), F.lit(1))))


def route_kind(content_type: Column, url: Column) -> Column:
    """pdf, html or other, by type first and suffix second."""
    m, p = mime_essence(F.coalesce(content_type, F.lit(""))), F.lower(path(url))
    return (
        F.when(m.contains("pdf") | F.endswith(p, F.lit(".pdf")), "pdf")
        .when(m.contains("html") | m.contains("xml") | m.startswith("text/"), "html")
        .when(m != "", "other")
        .when(p.rlike(r"\.(" + "|".join(_BINARY) + ")$"), "other")
        .otherwise("html")
    )


def extension(kind: Column) -> Column:
    return F.when(kind == "pdf", ".pdf").when(kind == "html", ".html").otherwise(".bin")


def title_from_url(url: Column) -> Column:
    """Readable title from the last path segment; null without one. A plus sign stays."""
    base = F.element_at(F.split(path(url), "/"), -1)
    plain = F.coalesce(F.try_url_decode(F.replace(base, F.lit("+"), F.lit("%2B"))), base)
    stem = F.regexp_replace(plain, r"(?<=[^.])\.[^.]*$", "")
    words = F.trim(F.regexp_replace(F.translate(stem, "_-", "  "), r"(?U)\s+", " "))
    return F.when(words != "", words)
