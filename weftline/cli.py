"""python -m weftline.cli COMMAND: the corpus commands over a folder of tables. Results are printed as JSON."""

from __future__ import annotations

import argparse
import html
import json
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import config
from .functions import language
from .operators import crawl, extract, merge, stats
from .operators.taxonomy import Taxonomy
from .sources import blobs, http, sitemap
from .sources.tables import Store


def stamp() -> str:
    return time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime())


def run_id() -> str:
    return time.strftime("run-%Y%m%dT%H%M%S", time.gmtime())


def size_text(n: float) -> str:
    """Bytes for people."""
    for unit in ("B", "KB", "MB", "GB"):
        if n < 1024:
            return f"{n:.0f} B" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1024
    return f"{n:.1f} TB"


def island(data) -> str:
    """JSON that can stand inside a script element."""
    return json.dumps(data, ensure_ascii=False, default=str).replace("</", "<\\/")


def _rows(df: DataFrame) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def fetch(store: Store, s: config.Settings, names: list[str] | None = None, fetcher=None) -> dict:
    """Crawls and keeps queue, log, links and raw blobs. Outcomes by site. fetcher: (url, site, ...) to fetch results, over the network if None."""
    spark, now, run = store.spark, stamp(), run_id()
    sites = config.choose(s, names)
    save = store.saver(run)
    get = fetcher or (lambda wave: http.fetch(wave, s.user_agent, s.delay))
    seeds = spark.createDataFrame([(x.seed_url, x.allowed_domain) for x in sites], "url string, site string")
    maps = None
    for k, x in enumerate(sites if s.use_sitemap else ()):
        home = "/".join(x.seed_url.split("/")[:3])
        plain = lambda t, d=x.allowed_domain: get(t.withColumn("site", F.lit(d)))
        one = sitemap.discover(spark, sitemap.seeds_of(spark, home, x.allowed_domain, plain), plain, store.saver(f"{run}/{k}"), domain=x.allowed_domain).withColumn("site", F.lit(x.allowed_domain))
        maps = one if maps is None else maps.unionByName(one)
    domains = [x.allowed_domain for x in sites]
    queue, raw = store.read("queue"), store.read("raw_docs")
    own, rest = queue.where(F.col("site").isin(domains)), queue.where(~F.col("site").isin(domains))
    after, got, edges = crawl.run(own, seeds, get, save, now, s.mode, s.retry_transient, maps, raw, s.per_site or None, s.per_host or None)
    log = got.select(F.lit(run).alias("run_id"), "url", "final_url", "site", "status", "content_type", "sha256", F.coalesce(F.length("data"), F.lit(0)).cast("bigint").alias("bytes"), "kind", "outcome", "error", F.lit(now).alias("fetched_at"))
    store.write("queue", rest.unionByName(after))
    store.write("raw_docs", crawl.insert_blobs(raw, blobs.new_blobs(got.where("outcome in ('new', 'changed')")), now))
    store.write("links", crawl.insert_edges(store.read("links"), edges.select("src", "dst", "site", "in_domain", "depth", F.lit(now).alias("first_seen_at"))))
    store.write("crawl_log", store.read("crawl_log").unionByName(log.withColumn("id", F.monotonically_increasing_id()), allowMissingColumns=True))
    store.write("documents", merge.remove(store.read("documents"), got.where("outcome = 'removed'"), now))
    return {r["site"]: {k: v for k, v in r.items() if k != "site"} for r in _rows(crawl.outcome_counts(log))}


def run_extract(store: Store, s: config.Settings, rules: Taxonomy | None = None, source_type: str | None = None, extractors=None) -> dict:
    """Extracts pending blobs, gates them and keeps the documents."""
    now, run = stamp(), run_id()
    before = store.read("raw_docs")
    raw = extract.recover(before, source_type)
    raw = raw if source_type is None else raw.where(F.col("source_type") == source_type)
    after, snapshot = extract.run(raw, store.read("queue"), store.read("documents"), now, store.saver(run), extractors, s.min_words)
    counts = _rows(extract.outcome_counts(raw, after))[0]
    store.write("documents", extract.reclassify(snapshot.drop("outcome"), rules or Taxonomy()))
    store.write("raw_docs", after if source_type is None else before.where(F.col("source_type") != source_type).unionByName(after))
    return counts


def dedup(store: Store) -> dict:
    docs = store.read("documents")
    live = docs.where("present").count()
    kept = store.write("documents", merge.retire_duplicates(docs, stamp())).where("present").count()
    return {"before": live, "retired": live - kept, "after": kept}


def backfill(store: Store) -> dict:
    docs = store.write("documents", merge.backfill(store.read("documents"), store.read("crawl_log"), language.detect))
    return _rows(docs.where("present").agg(F.count("*").alias("documents"), F.count("lang").alias("lang"), F.count("title").alias("title")))[0]


def reclassify(store: Store, rules: Taxonomy) -> dict:
    return {"reclassified": store.write("documents", extract.reclassify(store.read("documents"), rules)).count()}


def delta(store: Store, since: str) -> dict:
    up, gone = merge.delta(store.read("documents"), since)
    return {"upserts": _rows(up.orderBy("updated_at", "url")), "deletions": _rows(gone.orderBy("url"))}


def counts(store: Store) -> dict:
    queue, docs, raw = store.read("queue"), store.read("documents"), store.read("raw_docs")
    rejects = raw.where("extract_state = 'rejected'").groupBy("reject_reason").agg(F.count("*").alias("n"))
    return _rows(stats.state_counts(queue, docs, raw))[0] | {"rejects": {r["reject_reason"]: r["n"] for r in _rows(rejects)}, "by_department": {r["department"]: r["n"] for r in _rows(stats.by_class(docs, "department"))}, "by_campus": {r["campus"]: r["n"] for r in _rows(stats.by_class(docs, "campus"))}}


def reset(store: Store, s: config.Settings, names: list[str]) -> dict:
    out = {}
    for x in config.choose(s, names):
        tables = {k: store.read(k) for k in ("queue", "crawl_log", "documents", "links")}
        after = crawl.reset_site(tables, x.allowed_domain)
        out[x.name] = {k: tables[k].count() - after[k].count() for k in tables}
        for k, t in after.items():
            store.write(k, t)
    return out


def payload(store: Store, s: config.Settings) -> dict:
    """All of the report's numbers; every part is bounded in size but the list of sites."""
    queue, raw, links, log = (store.read(k) for k in ("queue", "raw_docs", "links", "crawl_log"))
    docs = store.read("documents")
    live = docs.where("present").withColumn("word_count", F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: w != "")))
    sites = stats.coverage(queue, live, [x.allowed_domain for x in s.sites])
    words = _rows(stats.word_range(live, s.min_words))[0]
    edges = _rows(stats.link_totals(links))[0] | {"docs_no_out": stats.without_links(live, links).count(), "top_external": _rows(stats.top_external(links))}
    return {
        "made": stamp(), "words": words, "by_type": _rows(stats.totals(live)), "histogram": _rows(stats.histogram(live)), "percentiles": _rows(stats.percentiles(live)), "raw": _rows(stats.raw_totals(raw))[0], "raw_by_type": _rows(stats.raw_by_type(raw)),
        "candidates": _rows(stats.candidates(queue, raw))[0]["candidates"], "distinct_texts": live.select("text_sha256").distinct().count(), "sites": _rows(sites), "reject_reasons": _rows(stats.top(raw.where("reject_reason is not null"), F.col("reject_reason"), "reason", 12)),
        "extract_errors": _rows(stats.extract_errors(raw)), "outcomes": _rows(stats.top(log, F.col("outcome"), "outcome", 12)), "statuses": _rows(stats.statuses(log)), "errors": _rows(stats.errors(log)),
        "errors_by_site": _rows(stats.error_breakdown(queue.where("work_state = 'error'").select("site", F.lit("error").alias("outcome"), F.col("http_status").alias("status")))), "links": edges, "hosts": _rows(stats.host_table(queue)), "freshness": _rows(stats.freshness(queue, docs, raw)),
        "findings": stats.findings(sites, words["n"], words["below"], s.min_words, edges),
    }


def render(data: dict) -> str:
    """The report as one HTML page: findings, then a table for each part, and the data as JSON."""
    e = lambda x: html.escape("" if x is None else str(x))
    table = lambda rows: "<table><tr>" + "".join(f"<th>{e(k)}</th>" for k in rows[0]) + "</tr>" + "".join("<tr>" + "".join(f"<td>{e(v)}</td>" for v in r.values()) + "</tr>" for r in rows) + "</table>" if rows else "<p>none</p>"
    parts = [f"<h2>{e(k)}</h2>" + table(v if isinstance(v, list) else [{a: b for a, b in v.items() if not isinstance(b, list)}]) for k, v in data.items() if isinstance(v, (list, dict))]
    return f'<!doctype html><meta charset="utf-8"><title>Corpus report</title><h1>Corpus report {e(data["made"])}</h1>{"".join(parts)}<script type="application/json" id="data">{island(data)}</script>'


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weftline")
    p.add_argument("--config")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("fetch", "run", "reset-site"):
        sub.add_parser(name).add_argument("--site", action="append", required=name == "reset-site")
    for name in ("extract", "extract-html", "extract-pdf", "stats", "dedup", "reclassify", "backfill"):
        sub.add_parser(name)
    sub.add_parser("report").add_argument("-o", "--output", default="analysis.html")
    sub.add_parser("delta").add_argument("--since", required=True)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    s = config.load(Path(a.config) if a.config else None)
    store = Store(spark or SparkSession.builder.getOrCreate(), s.folder)
    rules = Taxonomy(**{k: v if isinstance(v, (dict, str)) else tuple(tuple(tuple(y) if isinstance(y, list) else y for y in x) if isinstance(x, list) else x for x in v) for k, v in s.other.get("taxonomy", {}).items()})
    if a.command == "report":
        Path(a.output).write_text(render(payload(store, s)), "utf-8")
        print(f"wrote {a.output}")
        return 0
    out = {
        "fetch": lambda: fetch(store, s, a.site), "run": lambda: {"fetch": fetch(store, s, a.site), "extract": run_extract(store, s, rules), "dedup": dedup(store)}, "extract": lambda: run_extract(store, s, rules),
        "extract-html": lambda: run_extract(store, s, rules, "html"), "extract-pdf": lambda: run_extract(store, s, rules, "pdf"), "stats": lambda: counts(store), "dedup": lambda: dedup(store), "reclassify": lambda: reclassify(store, rules),
        "backfill": lambda: backfill(store), "delta": lambda: delta(store, a.since), "reset-site": lambda: reset(store, s, a.site),
    }[a.command]()
    print(json.dumps(out, indent=2, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
