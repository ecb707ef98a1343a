"""Conditional GET as a DataFrame operator: (url, etag, last_modified) to fetch results. Each URL has a connection of its own."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

SCHEMA = "url string, final_url string, status int, content_type string, data binary, etag string, last_modified string, error string"


def get(url: str, etag: str | None, modified: str | None, agent: str, timeout: float = 30.0) -> tuple:
    """A row of SCHEMA; failures are values, not exceptions."""
    request = urllib.request.Request(url, headers={"User-Agent": agent} | ({"If-None-Match": etag} if etag else {}) | ({"If-Modified-Since": modified} if modified else {}))
    try:
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return url, r.url, r.status, r.headers.get("Content-Type"), r.read(), r.headers.get("ETag"), r.headers.get("Last-Modified"), None
    except urllib.error.HTTPError as e:
        return url, e.url, e.code, e.headers.get("Content-Type"), None, e.headers.get("ETag"), e.headers.get("Last-Modified"), None if e.code == 304 else f"status {e.code}"
    except Exception as e:
        return url, url, 0, None, None, None, None, f"{type(e).__name__}: {e}"


def fetch(frontier: DataFrame, agent: str, delay: float = 1.0, sites: int = 200, getter: Callable = get) -> DataFrame:
    """Fetches a frontier with columns url, site and, if there, etag and last_modified. A site's URLs are in one partition, spaced by delay."""
    columns = [c if c in frontier.columns else f"cast(null as string) {c}" for c in ("url", "site", "etag", "last_modified")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, float] = {}
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                time.sleep(max(0.0, last.get(r.site, 0.0) + delay - time.monotonic()))
                last[r.site] = time.monotonic()
                rows.append(getter(r.url, r.etag, r.last_modified, agent))
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return frontier.selectExpr(*columns).repartition(sites, "site").mapInPandas(run, SCHEMA)
