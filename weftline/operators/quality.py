"""Quality gate: the first rule that a document breaks is its reason."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import trimmed, word_count

MARKERS = {
    "cookie": "accept all cookies|alle akzeptieren|cookie settings|cookie-einstellungen|datenschutzeinstellungen|diese webseite verwendet cookies|diese website verwendet cookies|necessary cookies|notwendige cookies|this website uses cookies|verwendung von cookies|we use cookies|wir verwenden cookies",
    "login": "angemeldet bleiben|benutzername und passwort|bitte melden sie sich an|forgot your password|keep me logged in|passwort vergessen|please log in|please sign in|zur anmeldung",
    "empty-state": "die angeforderte seite|diese seite existiert nicht|error 404|es wurden keine einträge gefunden|fehler 404|keine ergebnisse gefunden|keine treffer|no entries found|no results found|page not found|seite nicht gefunden|wurde nicht gefunden",
}


def boilerplate(text: Column) -> Column:
    """Category with the most distinct marker phrases, two at least; the first one of equals."""
    low = F.lower(text)
    hits = {k: sum((F.contains(low, F.lit(p)).cast("int") for p in v.split("|")), F.lit(0)) for k, v in MARKERS.items()}
    top = F.greatest(*hits.values())
    out = F.lit(None).cast("string")
    for k in reversed(MARKERS):
        out = F.when(hits[k] == top, k).otherwise(out)
    return F.when(top >= 2, out)


def link_words(markdown: Column) -> Column:
    """Words inside link anchors; images are no links."""
    anchors = F.regexp_extract_all(markdown, F.lit(r"(?<!!)\[([^\]]*)\]\([^)]*\)"), F.lit(1))
    return F.aggregate(anchors, F.lit(0), lambda n, a: n + word_count(a))


def reject_reason(text: Column, markdown: Column | None = None, min_words: int = 50) -> Column:
    """'ok' or why a document doesn't join the corpus."""
    t = trimmed(F.coalesce(text, F.lit("")))
    n = word_count(t)
    # markers count in short texts only; a text of over 120 words has more than 240 characters, and few texts have links
    category = boilerplate(t)
    out = F.when(t == "", "empty").when(n < min_words, F.format_string("too short: %d words", n)).when((n < 120) & category.isNotNull(), F.concat(F.lit("boilerplate/"), category))
    if markdown is not None:
        out = out.when(link_words(F.coalesce(markdown, F.lit(""))) > n * 0.6, "boilerplate/nav-only")
    return out.otherwise("ok")
