"""Rule taxonomy: campuses by host, programmes by path segment, departments by URL or keyword. The rules are data."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import urls


@dataclass(frozen=True)
class Taxonomy:
    """domains: domain to campus. satellites: (campus, patterns, parent). programs: (slug, department, path slugs), first match wins."""

    domains: dict[str, str] = field(default_factory=dict)
    satellites: tuple[tuple[str, tuple[str, ...], str], ...] = ()
    enumerations: tuple[str, ...] = ()
    programs: tuple[tuple[str, str, tuple[str, ...]], ...] = ()
    department_urls: tuple[tuple[str, str], ...] = ()
    department_words: dict[str, tuple[str, ...]] = field(default_factory=dict)
    version: str = "1"


def folded(url: Column) -> Column:
    return F.translate(F.lower(url), "_", "-")


def _any(c: Column, parts: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(c, F.lit(p))
    return out


def _chain(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    out = otherwise
    for when, then in reversed(cases):
        out = F.when(when, then).otherwise(out)
    return out


def campus(url: Column, t: Taxonomy) -> Column:
    """Campus of the longest domain that the host ends with, refined to a satellite except on enumeration pages."""
    h = urls.host(url)
    by_host = [((h == d) | F.endswith(h, F.lit("." + d)), F.lit(s)) for d, s in sorted(t.domains.items(), key=lambda x: -len(x[0]))]
    base = _chain(by_host, F.lit(None).cast("string"))
    low = folded(url)
    near = [((base == parent) & _any(low, parts), F.lit(s)) for s, parts, parent in t.satellites]
    return F.when(_any(low, t.enumerations), base).otherwise(_chain(near, base))


def _starts(slug: str):
    return lambda s: (s == slug) | F.startswith(s, F.lit(slug + "-"))


def _program(url: Column, t: Taxonomy, which: int) -> Column:
    segments = F.split(urls.path(folded(url)), "/")
    cases = []
    for p in t.programs:
        own = F.lit(False)
        for slug in p[2]:
            own = own | F.exists(segments, _starts(slug))
        cases.append((own, F.lit(p[which])))
    return F.when(~_any(folded(url), t.enumerations), _chain(cases, F.lit(None).cast("string")))


def classify(url: Column, title: Column, description: Column, t: Taxonomy) -> Column:
    """struct(campus, department, program, department_source, version); a programme decides the department."""
    program, own = _program(url, t, 0), _program(url, t, 1)
    by_url = _chain([(F.contains(folded(url), F.lit(p)), F.lit(d)) for p, d in t.department_urls], F.lit(None).cast("string"))
    blob = F.lower(F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(description, F.lit(""))))
    hits = F.array_compact(F.array(*(F.when(blob.rlike(r"(?U)\b(" + "|".join(map(re.escape, w)) + r")\b"), F.lit(d)) for d, w in t.department_words.items()))) if t.department_words else F.array().cast("array<string>")
    single = F.when(F.size(hits) == 1, F.try_element_at(hits, F.lit(1)))
    source = F.when(program.isNotNull(), "program").when(by_url.isNotNull(), "url").when(single.isNotNull(), "keyword").otherwise("default")
    return F.struct(campus(url, t).alias("campus"), F.coalesce(own, by_url, single, F.lit("unknown")).alias("department"), program.alias("program"), source.alias("department_source"), F.lit(t.version).alias("version"))
