"""Sitemaps: parsed by pattern, since broken XML has to give what it can."""

from __future__ import annotations

import gzip
import re
import zlib
from collections.abc import Callable
from itertools import count

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import urls

_ENTITY = re.compile(r"&(?:(amp|lt|gt|quot|apos)|#(?:[xX]([0-9a-fA-F]+)|([0-9]+)));")
_NAMES = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}


@F.pandas_udf(T.StringType())
def decode(data: pd.Series) -> pd.Series:
    """Text of a body that may be a gzip member, told by its first bytes."""

    def one(b):
        if b is None:
            return None
        try:
            return (gzip.decompress(b) if b[:2] == b"\x1f\x8b" else b).decode("utf-8", "replace")
        except (OSError, EOFError, zlib.error):
            return b.decode("utf-8", "replace")

    return data.map(one)


def _entity(m: re.Match) -> str:
    if m[1]:
        return _NAMES[m[1]]
    code = int(m[2], 16) if m[2] else int(m[3])
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else m[0]


@F.pandas_udf(T.StringType())
def unescape(s: pd.Series) -> pd.Series:
    """The five names of XML and numbers; all else stays as it is, other names of HTML too."""
    return s.map(lambda x: None if x is None else _ENTITY.sub(_entity, x).strip())


def _loc(block, tag: str):
    return F.regexp_extract(block, rf"(?is)<{tag}[^>]*>\s*(?:<!\[CDATA\[)?\s*(.*?)\s*(?:\]\]>)?\s*</{tag}>", 1)


def entries(xml: DataFrame, column: str = "xml") -> DataFrame:
    """(sitemap, place, url, lastmod) of every url block; lastmod is null without one."""
    name = F.col("url") if "url" in xml.columns else F.lit(None).cast("string")
    b = xml.select(name.alias("sitemap"), F.posexplode(F.regexp_extract_all(column, F.lit(r"(?is)(<url\b[^>]*>.*?</url>)"), F.lit(1))).alias("place", "block"))
    out = b.select("sitemap", "place", unescape(_loc(F.col("block"), "loc")).alias("url"), F.nullif(unescape(_loc(F.col("block"), "lastmod")), F.lit("")).alias("lastmod"))
    return out.where("url <> ''")


def nested(xml: DataFrame, column: str = "xml") -> DataFrame:
    """(url) of every sitemap block."""
    b = xml.select(F.explode(F.regexp_extract_all(column, F.lit(r"(?is)(<sitemap\b[^>]*>.*?</sitemap>)"), F.lit(1))).alias("block"))
    return b.select(unescape(_loc(F.col("block"), "loc")).alias("url")).where("url <> ''")


def robots_sitemaps(text: DataFrame, column: str = "text") -> DataFrame:
    """(url) of every Sitemap line."""
    line = text.select(F.explode(F.split(column, r"\r?\n")).alias("line"))
    return line.select(F.trim(F.regexp_extract("line", r"(?i)^\s*sitemap\s*:(.*)$", 1)).alias("url")).where("url <> ''")


def seeds_of(spark: SparkSession, home: str, domain: str, fetch: Callable[[DataFrame], DataFrame]) -> list[str]:
    """A site's /sitemap.xml and the sitemaps in its domain that its robots.txt names."""
    got = fetch(spark.createDataFrame([(f"{home}/robots.txt",)], "url string")).select(F.col("data").cast("string").alias("text"))
    named = robots_sitemaps(got).where(urls.in_domain(F.col("url"), F.lit(domain)))
    return [f"{home}/sitemap.xml", *(r.url for r in named.collect())]  # lines of one robots.txt


def discover(spark: SparkSession, seeds: list[str], fetch: Callable[[DataFrame], DataFrame], save: Callable[[str, int, DataFrame], DataFrame], most: int | None = None, domain: str | None = None) -> DataFrame:
    """(url, lastmod) of all sitemaps reached from seeds through their indexes, each once; with a domain only what is in it, indexes and pages. The
    last entry of a URL wins: that of the deepest level, there the one of the last sitemap by name. fetch: (url) to (url, data). If indexes are left after `most` levels, it raises."""
    inside = F.lit(True) if domain is None else urls.in_domain(F.col("url"), F.lit(domain))
    todo = spark.createDataFrame([(s,) for s in dict.fromkeys(seeds)], "url string")
    seen, found = todo, []
    for k in count():
        xml = save("sitemaps", k, fetch(todo).withColumn("xml", decode("data")))
        found.append(entries(xml).where(inside).withColumn("wave", F.lit(k)))
        todo = save("todo", k, nested(xml).where(inside).distinct().join(seen, "url", "left_anti"))
        if todo.isEmpty():
            break
        if k + 1 == most:
            raise RuntimeError(f"sitemaps are left after {k + 1} levels")
        seen = seen.unionByName(todo)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.groupBy("url").agg(F.max_by(F.struct("lastmod"), F.struct("wave", "sitemap", "place")).alias("last")).select("url", "last.lastmod")
