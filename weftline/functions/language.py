"""Language by function words: a small scorer of its own, with a floor of 20 characters and of confidence."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS = {
    "de": "der die das und ist nicht ein eine zu mit den von für auf dem im des auch sich werden oder wird wir sie".split(),
    "en": "the of and to in is that for it with as was on are be this by at from or have not we you".split(),
    "es": "el la de que y en los del las por con una para es se no al lo como más su un sus pero".split(),
    "fr": "le la les de des et est un une pour dans que qui pas sur au avec ce il sont nous vous par du".split(),
}
_SETS = {k: frozenset(v) for k, v in WORDS.items()}


def guess(text: str, floor: float = 0.5) -> str | None:
    """As detect, for one string."""
    if len(text) < 20:
        return None
    words = re.split(r"[^\w]+|[\d_]+", text[:10000].lower())
    hits = {k: sum(w in v for w in words) for k, v in _SETS.items()}
    best = max(sorted(hits), key=hits.get)
    return best if hits[best] > floor * sum(hits.values()) else None


def _among(words: list[str]):
    return lambda w: w.isin(words)


def detect(text: Column, floor: float = 0.5) -> Column:
    """Language whose function words have more than `floor` of all hits among the first 10,000 characters; null below 20 characters or without one."""
    words = F.split(F.lower(F.substring(text, 1, 10000)), r"[^\p{L}]+")
    hits = {k: F.size(F.filter(words, _among(v))) for k, v in WORDS.items()}
    total = sum(hits.values(), F.lit(0))
    best = F.greatest(*hits.values())
    out = F.lit(None).cast("string")
    for k in reversed(sorted(WORDS)):
        out = F.when(hits[k] == best, k).otherwise(out)
    return F.when((F.length(text) >= 20) & (total > 0) & (best > total * floor), out)
