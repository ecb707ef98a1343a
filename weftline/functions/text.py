"""Text columns: normalisation, hashes, word counts, markdown and titles."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space as Python's str.split sees it.
SPACE = r"(?U)[\s\x1c-\x1f]+"


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: x if x is None or x.isascii() or unicodedata.is_normalized("NFC", x) else unicodedata.normalize("NFC", x))


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def normalize(text: Column, nfc: bool = True) -> Column:
    """NFC, runs of white space as one space, stripped. nfc=False stays inside the JVM, for text known to be in NFC."""
    return F.trim(F.regexp_replace(_nfc(text) if nfc else text, SPACE, " "))


def text_hash(text: Column, nfc: bool = True) -> Column:
    return F.sha2(normalize(F.coalesce(text, F.lit("")), nfc), 256)


def document_id(url: Column) -> Column:
    return F.substring(F.sha1(url), 1, 16)


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda x: x != ""))


def markdown_to_text(md: Column) -> Column:
    """Plain text of markdown; rules, images, links, headings, quotes, list marks, emphasis and table bars go, in that order."""
    for pattern, to in (
        (r"(?Umd)^\s*\|?(?:\s*[-*_:]{3,}\s*\|?)+\s*$", ""), (r"!\[[^\]]*\]\([^)]*\)", ""), (r"\[([^\]]*)\]\([^)]*\)", "$1"), (r"(?Umd)^\s{0,3}#{1,6}\s+", ""),
        (r"(?Umd)^\s{0,3}>\s?", ""), (r"(?Umd)^\s*[-*+]\s+", ""), (r"\*\*|\*|__|_|`", ""), (r"\|", " "), (r"[ \t]+", " "), (r"\n{3,}", "\n\n"),
    ):
        md = F.regexp_replace(md, pattern, to)
    return trimmed(md)


def heading_title(md: Column) -> Column:
    """First heading of level 1, null without one."""
    t = trimmed(F.regexp_extract(md, r"(?md)^# (.*)$", 1))
    return F.when(t != "", t)


def clean_title(raw: Column) -> Column:
    """An embedded title; null for placeholders, names of tools and bare file names."""
    t = trimmed(raw)
    low = F.lower(t)
    junk = low.isin("document1", "dokument1", "title", "unbenannt", "untitled") | low.rlike("^microsoft (word|powerpoint|excel) -") | low.rlike(r"(?U)^[\w .\-]+\.(pdf|docx?|pptx?|xlsx?)\z")
    return F.when((t != "") & ~junk, t)
