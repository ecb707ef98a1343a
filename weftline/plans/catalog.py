"""Queries of the corpus engine over the driver's tables, and their SQL.

The driver has no crawl tables. documents stand for extracted pages, each at https://<source>.example/doc/<doc_id>, with
a query string on every third; events for the crawl log, their event type being the outcome; pages for fetched pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import language, links, text, urls
from ..operators import crawl, merge, quality, stats, taxonomy, tree
from ..sources import sitemap
from . import cases, report

NOW, THEN = "2026-01-02T00:00:00", "2026-01-01T00:00:00"
RULES = taxonomy.Taxonomy(
    domains={"org": "main", "example.org": "example", "example.com": "north", "net": "south"},
    satellites=(("north-annex", ("/blog", "/news"), "north"), ("main-annex", ("/a", "/b"), "main")),
    enumerations=("/index", "/list"),
    programs=(("p-one", "tech", ("article", "page")), ("p-two", "arts", ("docs", "wiki"))),
    department_urls=(("/s", "science"),),
    department_words={"tech": ("code", "data"), "arts": ("music", "text")},
    version="2",
)


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def doc_url() -> Column:
    base = F.concat(F.lit("https://"), F.col("source"), F.lit(".example/doc/"), F.col("doc_id").cast("string"))
    return F.when(F.col("doc_id") % 3 == 0, F.concat(base, F.lit("?v="), (F.col("doc_id") % 7).cast("string"))).otherwise(base)


_URL = "'https://' || source || '.example/doc/' || doc_id || CASE WHEN doc_id % 3 = 0 THEN '?v=' || (doc_id % 7) ELSE '' END"
_NORM = r"trim(regexp_replace(nfc_normalize(coalesce(text, '')), '\s+', ' ', 'g'))"
_WORDS = r"len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> ''))"
_PARAMS = "len(list_filter(string_split(regexp_extract(url, '\\?(.*)$', 1), '&'), lambda x: x <> ''))"
_HOST = "lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#:]*)', 1))"


def _docs(spark, sf):
    return _t(spark, sf, "documents").withColumn("url", doc_url())


def text_dedup(spark, sf):
    return merge.dedup_texts(_docs(spark, sf)).where("canonical").select("url", "doc_id", "text_sha256")


_DEDUP = f"""d AS (SELECT doc_id, {_URL} AS url, sha256({_NORM}) AS text_sha256 FROM documents),
    k AS (SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY {_PARAMS}, length(url), url) AS k FROM d)"""


def dedup_summary(spark, sf):
    g = merge.dedup_texts(_docs(spark, sf)).groupBy("text_sha256").agg(F.count("*").alias("n"))
    return g.agg(F.count_if(F.col("n") > 1).alias("groups"), F.sum(F.col("n") - 1).alias("deleted"), F.sum("n").alias("before"), F.count("*").alias("after"))


def word_count_hist(spark, sf):
    return stats.histogram(_t(spark, sf, "documents").select(text.word_count(F.col("text")).alias("word_count")))


def _hist_sql() -> str:
    # bounds by hand, so that a wrong constant shows
    return f"""WITH w AS (SELECT {_WORDS} AS n FROM documents), b(bucket, low, high) AS (VALUES ('0-49', 0, 50), ('50-99', 50, 100), ('100-249', 100, 250), ('250-499', 250, 500), ('500-999', 500, 1000), ('1000-2499', 1000, 2500),
        ('2500-4999', 2500, 5000), ('5000+', 5000, 2000000000)) SELECT bucket, low::INT AS low, (SELECT count(*) FROM w WHERE n >= low AND n < high) AS n FROM b"""


def word_percentiles(spark, sf):
    return stats.percentiles(_t(spark, sf, "documents").select(text.word_count(F.col("text")).alias("word_count")))


def quality_gate(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", quality.reject_reason(F.col("text"), F.col("text")).alias("reason"))


def _gate_sql() -> str:
    hits = {k: " + ".join(f"contains(low, '{p}')::INT" for p in v.split("|")) for k, v in quality.MARKERS.items()}
    top = "greatest(" + ", ".join(hits.values()) + ")"
    cat = "CASE WHEN " + top + " < 2 THEN NULL " + " ".join(f"WHEN {h} = {top} THEN '{k}'" for k, h in hits.items()) + " END"
    return f"""WITH w AS (SELECT doc_id, {_WORDS} AS n, lower(text) AS low, regexp_replace(text, '!\\[[^\\]]*\\]\\([^)]*\\)', '', 'g') AS md FROM documents),
    c AS (SELECT *, {cat} AS cat, list_sum(list_transform(regexp_extract_all(md, '\\[([^\\]]*)\\]\\([^)]*\\)', 1), lambda a: len(list_filter(string_split_regex(a, '\\s+'), lambda x: x <> '')))) AS link FROM w)
    SELECT doc_id, CASE WHEN n = 0 THEN 'empty' WHEN n < 50 THEN 'too short: ' || n || ' words' WHEN n < 120 AND cat IS NOT NULL THEN 'boilerplate/' || cat
    WHEN coalesce(link, 0) > n * 0.6 THEN 'boilerplate/nav-only' ELSE 'ok' END AS reason FROM c"""


def reject_reasons(spark, sf):
    return stats.top(quality_gate(spark, sf).where("reason <> 'ok'"), F.col("reason"), "reason", 12)


def url_parts(spark, sf):
    u = F.col("url")
    return _t(spark, sf, "pages").select(
        "page_id", urls.host(u).alias("host"), urls.path(u).alias("path"), urls.query(u).alias("query"), F.size(urls.query_pairs(u)).alias("n_params"), urls.route_kind(F.lit(None).cast("string"), u).alias("kind"), urls.is_trap(u).alias("trap"),
        urls.in_domain(u, F.lit("example.org")).alias("inside"), text.document_id(u).alias("id"),
    )


_PARTS = f"""SELECT page_id, {_HOST} AS host, regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '\\?([^#]*)', 1) AS query,
    len(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> ''))::INT AS n_params, CASE WHEN regexp_matches(lower(url), '\\.pdf([?#]|$)') THEN 'pdf' ELSE 'html' END AS kind,
    regexp_matches({_HOST}, '^(buchen|moodle|elearning)') OR contains(url, '/calendar/view.php') OR regexp_matches(lower(regexp_extract(url, '\\?([^#]*)', 1)), '(^|&)(replytocom|forcedownload|tx_solr)') AS trap,
    {_HOST} = 'example.org' OR {_HOST} LIKE '%.example.org' AS inside, substr(sha1(url), 1, 16) AS id FROM pages"""


def link_edges(spark, sf):
    e = links.link_edges(_t(spark, sf, "pages"))
    return e.groupBy("src").agg(F.count("*").alias("links"), F.count_if("in_domain").alias("inside"), F.count_if("trap").alias("traps"))


_HREFS = """h AS (SELECT url AS src, unnest(regexp_extract_all(html, '<a\\s[^>]*?href="([^"#]*)', 1)) AS href FROM pages),
    e AS (SELECT DISTINCT src, href FROM h WHERE href LIKE '/%')"""


def link_totals(spark, sf):
    return stats.link_totals(links.link_edges(_t(spark, sf, "pages"))).select("total", "in_domain", "external", "distinct_src")


def docs_without_links(spark, sf):
    p = _t(spark, sf, "pages")
    return stats.without_links(p.select("page_id", "url"), links.link_edges(p)).select("page_id", "url")


def host_states(spark, sf):
    p = _t(spark, sf, "pages").withColumn("work_state", F.element_at(F.array(F.lit("done"), F.lit("error"), F.lit("pending")), (F.col("page_id") % 3 + 1).cast("int")))
    return stats.pivot_states(p, urls.host(F.col("url")), "host")


def top_hosts(spark, sf):
    p = _t(spark, sf, "pages").withColumn("work_state", F.element_at(F.array(F.lit("done"), F.lit("error"), F.lit("pending")), (F.col("page_id") % 3 + 1).cast("int")))
    return stats.host_table(p)


def crawl_outcomes(spark, sf):
    e = _t(spark, sf, "events")
    return stats.top(e, F.col("event_type"), "outcome", 12)


def _log(spark, sf):
    return _t(spark, sf, "events").select(F.col("event_id").alias("id"), (F.col("user_id") % 5).cast("string").alias("site"), F.lit("error").alias("outcome"), F.element_at(F.array(*map(F.lit, (0, 200, 404, 429, 500, 503, 410, 301))), (F.col("event_id") % 8 + 1).cast("int")).alias("status"))


_LOG = "log AS (SELECT event_id AS id, (user_id % 5)::VARCHAR AS site, [0, 200, 404, 429, 500, 503, 410, 301][(event_id % 8 + 1)::INT] AS status FROM events)"


def transient_retry(spark, sf):
    return _log(spark, sf).groupBy("status", crawl.is_transient(F.col("status")).alias("transient")).agg(F.count("*").alias("n"))


def error_breakdown(spark, sf):
    return stats.error_breakdown(_log(spark, sf))


def _snapshots(spark, sf):
    d = _docs(spark, sf).withColumn("text_sha256", text.text_hash(F.col("text")))
    cols = lambda df, body: df.select("url", F.col("url").alias("final_url"), F.col("source").alias("site"), F.lit("html").alias("source_type"), F.sha2(body, 256).alias("content_sha256"), F.lit(None).cast("string").alias("title"), body.alias("text"), "lang", F.sha2(text.normalize(body), 256).alias("text_sha256"))
    one, two = F.coalesce("text", F.lit("")), F.when(F.col("doc_id") % 5 == 0, F.concat(F.coalesce("text", F.lit("")), F.lit(" v2"))).otherwise(F.coalesce("text", F.lit("")))
    return cols(d.where("doc_id % 4 <> 3"), one), cols(d.where("doc_id % 4 <> 1"), two)


def change_detect(spark, sf):
    a, b = _snapshots(spark, sf)
    return merge.detect_changes(a, b)


_SNAP = f"""a AS (SELECT {_URL} AS url, coalesce(text, '') AS text FROM documents WHERE doc_id % 4 <> 3),
    b AS (SELECT {_URL} AS url, coalesce(text, '') || CASE WHEN doc_id % 5 = 0 THEN ' v2' ELSE '' END AS text FROM documents WHERE doc_id % 4 <> 1)"""


def _empty_snapshot(df: DataFrame) -> DataFrame:
    return df.where("false").selectExpr("*", "true present", "1 revision", "'' first_indexed_at", "'' updated_at")


def _upserted(spark, sf):
    a, b = _snapshots(spark, sf)
    first = merge.upsert(_empty_snapshot(a), a, THEN).drop("outcome")
    return merge.upsert(first, b, NOW)


def document_upsert(spark, sf):
    return _upserted(spark, sf).select("url", "outcome", "present", "revision", "first_indexed_at", "updated_at", "text_sha256")


_H = _NORM.replace("coalesce(text, '')", "text")
_UPSERT = f"""{_SNAP},
    ah AS (SELECT url, sha256({_H}) AS h FROM a), bh AS (SELECT url, sha256({_H}) AS h FROM b),
    o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY {_PARAMS}, length(url), url) AS k FROM ah) WHERE k = 1),
    j AS (SELECT coalesce(o.url, bh.url) AS url, o.h AS oh, bh.h AS nh, coalesce(bh.h, o.h) AS h FROM o FULL JOIN bh ON o.url = bh.url),
    r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY {_PARAMS}, length(url), url) AS k FROM j),
    u AS (SELECT url, CASE WHEN k > 1 THEN CASE WHEN nh IS NULL THEN 'retired' ELSE 'duplicate' END WHEN nh IS NULL THEN 'kept' WHEN oh IS NULL THEN 'new' WHEN nh <> oh THEN 'changed' ELSE 'unchanged' END AS outcome, oh, nh FROM r WHERE NOT (k > 1 AND oh IS NULL)),
    s AS (SELECT url, outcome, outcome NOT IN ('retired', 'duplicate') AS present, CASE WHEN outcome = 'changed' THEN 2 ELSE 1 END AS revision, CASE WHEN outcome = 'new' THEN '{NOW}' ELSE '{THEN}' END AS first_indexed_at,
        CASE WHEN outcome IN ('kept', 'unchanged') THEN '{THEN}' ELSE '{NOW}' END AS updated_at, CASE WHEN outcome IN ('new', 'changed', 'unchanged') THEN nh ELSE oh END AS text_sha256 FROM u)"""


def delta_upserts(spark, sf):
    return merge.delta(_upserted(spark, sf), THEN)[0].select("url", "revision", "updated_at")


def delta_deletions(spark, sf):
    return merge.delta(_upserted(spark, sf), THEN)[1]


def retire_duplicates(spark, sf):
    d = _docs(spark, sf).withColumn("text_sha256", F.lit(None).cast("string"))
    s = d.select("url", "text", "text_sha256").selectExpr("*", "true present", "1 revision", f"'{THEN}' first_indexed_at", f"'{THEN}' updated_at")
    return merge.retire_duplicates(s, NOW).select("url", "present", "updated_at")


def budget_admission(spark, sf):
    p = _t(spark, sf, "pages").select("url", (F.col("page_id") % 4).cast("string").alias("site"), F.length(F.regexp_replace(urls.path(F.col("url")), "[^/]", "")).alias("depth"))
    return crawl.admit(p, per_site=2000, per_host=20).select("site", "host", "url", "depth")


def enqueue(spark, sf):
    p = _t(spark, sf, "pages").select("url", "page_id")
    found = p.select("url", F.lit("s").alias("site"), F.lit(None).cast("string").alias("discovered_from"), F.lit(1).alias("depth"))
    return crawl.enqueue(p.where("page_id % 3 = 0"), found.unionByName(found)).select("url", "depth", "work_state")


def classify(spark, sf):
    p = _t(spark, sf, "pages")
    return p.select("page_id", taxonomy.classify(F.col("url"), F.lit(""), F.lit(""), RULES).alias("c")).select("page_id", "c.*")


def _classify_sql() -> str:
    low = "replace(lower(url), '_', '-')"
    path = f"regexp_extract({low}, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
    seg = lambda slugs: " OR ".join(f"list_contains(seg, '{s}') OR len(list_filter(seg, lambda x: starts_with(x, '{s}-'))) > 0" for s in slugs)
    any_ = lambda parts: "(" + " OR ".join(f"contains(low, '{p}')" for p in parts) + ")"
    base = "CASE " + " ".join(f"WHEN host = '{d}' OR ends_with(host, '.{d}') THEN '{s}'" for d, s in sorted(RULES.domains.items(), key=lambda x: -len(x[0]))) + " END"
    sat = "CASE WHEN enum THEN base " + " ".join(f"WHEN base = '{p}' AND {any_(parts)} THEN '{s}'" for s, parts, p in RULES.satellites) + " ELSE base END"
    prog = lambda k: "CASE WHEN enum THEN NULL " + " ".join(f"WHEN {seg(p[2])} THEN '{p[k]}'" for p in RULES.programs) + " END"
    return f"""WITH a AS (SELECT page_id, {low} AS low, {_HOST} AS host, string_split({path}, '/') AS seg FROM pages),
    b AS (SELECT *, {base} AS base, {any_(RULES.enumerations)} AS enum, CASE WHEN {any_((RULES.department_urls[0][0],))} THEN '{RULES.department_urls[0][1]}' END AS by_url FROM a),
    c AS (SELECT *, {prog(0)} AS program, {prog(1)} AS dept FROM b)
    SELECT page_id, {sat} AS campus, coalesce(dept, by_url, 'unknown') AS department, program, CASE WHEN program IS NOT NULL THEN 'program' WHEN by_url IS NOT NULL THEN 'url' ELSE 'default' END AS department_source, '2' AS version FROM c"""


def title_from_url(spark, sf):
    return _t(spark, sf, "pages").select("page_id", urls.title_from_url(F.col("url")).alias("title"))


def markdown_to_text(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", F.sha2(text.markdown_to_text(F.col("text")), 256).alias("plain_sha256"))


def language_detect(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", language.detect(F.col("text")).alias("detected"))


def totals(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("lang").alias("source_type"), text.word_count(F.col("text")).alias("word_count"), F.lit(True).alias("present"))
    return stats.totals(d)


def coverage(spark, sf):
    d = _t(spark, sf, "documents").select(F.col("source").alias("site"), text.word_count(F.col("text")).alias("word_count"), F.lit(True).alias("present"), F.element_at(F.array(F.lit("done"), F.lit("error"), F.lit("pending")), (F.col("doc_id") % 3 + 1).cast("int")).alias("work_state"))
    return stats.coverage(d, d, []).select("site", "total", "done", "error", "pending", "docs", "words", F.round("error_rate", 6).alias("error_rate"))


def discovery_tree(spark, sf):
    p = _t(spark, sf, "pages").select((F.col("page_id") % 4).cast("string").alias("site"), F.concat(F.lit("https://t.example/"), F.col("page_id")).alias("url"), F.when(F.col("page_id") >= 4, F.concat(F.lit("https://t.example/"), F.col("page_id") - 4)).alias("discovered_from"), F.lit("done").alias("work_state"))
    return tree.discovery_trees(p).groupBy("site").agg(F.max("kept").alias("kept"), F.count("*").alias("nodes"), F.max("truncated").alias("truncated"))


def sitemap_entries(spark, sf):
    x = _t(spark, sf, "pages").select(F.concat(F.lit("<urlset><url><loc>"), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit("</loc><lastmod>"), F.col("page_id").cast("string"), F.lit("</lastmod></url></urlset>")).alias("xml"))
    return sitemap.entries(x).select("url", "lastmod")


def url_interning(spark, sf):
    p = _t(spark, sf, "pages")
    known = p.where("page_id < 10").select((F.col("page_id") + 1).alias("id"), "url")
    return merge.intern(known, p, "url")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        text_dedup, dedup_summary, word_count_hist, word_percentiles, quality_gate, reject_reasons, url_parts, link_edges, link_totals, docs_without_links, host_states, top_hosts, crawl_outcomes, transient_retry,
        error_breakdown, change_detect, document_upsert, delta_upserts, delta_deletions, retire_duplicates, budget_admission, enqueue, classify, title_from_url, markdown_to_text, language_detect, totals, coverage, discovery_tree, sitemap_entries, url_interning,
    )
}
ORACLES: dict[str, str] = {
    "text_dedup": f"WITH {_DEDUP} SELECT url, doc_id, text_sha256 FROM k WHERE k = 1",
    "dedup_summary": f"WITH {_DEDUP}, g AS (SELECT count(*) AS n FROM d GROUP BY text_sha256) SELECT count(*) FILTER (n > 1) AS groups, sum(n - 1)::BIGINT AS deleted, sum(n)::BIGINT AS before, count(*) AS after FROM g",
    "word_count_hist": _hist_sql(),
    "word_percentiles": f"WITH w AS (SELECT {_WORDS} AS n FROM documents), r AS (SELECT n, row_number() OVER (ORDER BY n) - 1 AS i, count(*) OVER () AS c FROM w), p AS (SELECT unnest([{', '.join(map(str, stats.PERCENTS))}]) AS percent) SELECT percent::INT AS percent, n::INT AS value FROM p JOIN r ON i = least(c - 1, floor(percent * c / 100))",
    "quality_gate": _gate_sql(),
    "reject_reasons": f"SELECT reason, count(*) AS n FROM ({_gate_sql()}) WHERE reason <> 'ok' GROUP BY reason ORDER BY n DESC, reason LIMIT 12",
    "url_parts": _PARTS,
    "link_edges": f"WITH {_HREFS} SELECT src, count(*) AS links, count(*) AS inside, 0::BIGINT AS traps FROM e GROUP BY src",
    "link_totals": f"WITH {_HREFS} SELECT count(*) AS total, count(*) AS in_domain, 0::BIGINT AS external, count(DISTINCT src) AS distinct_src FROM e",
    "docs_without_links": f"WITH {_HREFS} SELECT page_id, url FROM pages WHERE url NOT IN (SELECT src FROM e)",
    "host_states": f"SELECT {_HOST} AS host, count(*) AS total, count(*) FILTER (page_id % 3 = 0) AS done, count(*) FILTER (page_id % 3 = 1) AS error, count(*) FILTER (page_id % 3 = 2) AS pending, 0::BIGINT AS in_progress FROM pages GROUP BY 1",
    "top_hosts": "SELECT lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)) AS host, count(*) AS urls, count(*) FILTER (page_id % 3 = 0) AS done, count(*) FILTER (page_id % 3 = 1) AS error, count(*) FILTER (page_id % 3 = 2) AS pending FROM pages GROUP BY 1 ORDER BY urls DESC, host LIMIT 25",
    "crawl_outcomes": "SELECT event_type AS outcome, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, outcome NULLS FIRST LIMIT 12",
    "transient_retry": f"WITH {_LOG} SELECT status::INT AS status, status IN (0, 408, 429) OR status BETWEEN 500 AND 599 AS transient, count(*) AS n FROM log GROUP BY 1, 2",
    "error_breakdown": f"WITH {_LOG}, g AS (SELECT site, status, count(*) AS n FROM log GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY n DESC, status) AS k, sum(n) OVER (PARTITION BY site) AS errors FROM g) SELECT site, any_value(errors)::BIGINT AS errors, string_agg(status || ':' || n, ', ' ORDER BY k) AS statuses FROM k WHERE k <= 6 GROUP BY site",
    "change_detect": f"WITH {_SNAP} SELECT coalesce(a.url, b.url) AS url, CASE WHEN a.url IS NULL THEN 'new' WHEN b.url IS NULL THEN 'removed' WHEN a.text = b.text THEN 'unchanged' ELSE 'changed' END AS outcome FROM a FULL JOIN b ON a.url = b.url",
    "document_upsert": f"WITH {_UPSERT} SELECT * FROM s",
    "delta_upserts": f"WITH {_UPSERT} SELECT url, revision, updated_at FROM s WHERE present AND updated_at > '{THEN}'",
    "delta_deletions": f"WITH {_UPSERT} SELECT url, updated_at FROM s WHERE NOT present AND updated_at > '{THEN}'",
    "retire_duplicates": f"WITH {_DEDUP} SELECT url, k = 1 AS present, CASE WHEN k = 1 THEN '{THEN}' ELSE '{NOW}' END AS updated_at FROM k",
    "budget_admission": f"WITH p AS (SELECT url, (page_id % 4)::VARCHAR AS site, {_HOST} AS host, length(regexp_replace(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '[^/]', '', 'g'))::INT AS depth FROM pages), h AS (SELECT *, row_number() OVER (PARTITION BY site, host ORDER BY depth, url) AS k FROM p), s AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY depth, url) AS q FROM h WHERE k <= 20) SELECT site, host, url, depth FROM s WHERE q <= 2000",
    "enqueue": "SELECT url, 1 AS depth, 'pending' AS work_state FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0) GROUP BY url",
    "classify": _classify_sql(),
    "title_from_url": "WITH b AS (SELECT page_id, string_split(regexp_extract(url, '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1), '/')[-1] AS base FROM pages), s AS (SELECT page_id, trim(regexp_replace(translate(regexp_replace(url_decode(base), '([^.])\\.[^.]*$', '\\1'), '_-', '  '), '\\s+', ' ', 'g')) AS t FROM b) SELECT page_id, CASE WHEN t <> '' THEN t END AS title FROM s",
    "totals": f"WITH w AS (SELECT lang AS source_type, {_WORDS} AS n FROM documents) SELECT source_type, count(*) AS docs, sum(n)::BIGINT AS words, max(n)::INT AS longest, sum(n)::DOUBLE / count(*) AS average FROM w GROUP BY 1",
    "coverage": f"WITH w AS (SELECT source AS site, doc_id % 3 AS m, {_WORDS} AS n FROM documents) SELECT site, count(*) AS total, count(*) FILTER (m = 0) AS done, count(*) FILTER (m = 1) AS error, count(*) FILTER (m = 2) AS pending, count(*) AS docs, sum(n)::BIGINT AS words, round(CASE WHEN count(*) FILTER (m < 2) > 0 THEN count(*) FILTER (m = 1)::DOUBLE / count(*) FILTER (m < 2) ELSE 0 END, 6) AS error_rate FROM w GROUP BY 1",
    "sitemap_entries": "SELECT trim(url) AS url, page_id::VARCHAR AS lastmod FROM pages",
    "url_interning": "WITH k AS (SELECT page_id + 1 AS id, url FROM pages WHERE page_id < 10), n AS (SELECT DISTINCT url FROM pages WHERE url NOT IN (SELECT url FROM k)) SELECT id, url FROM k UNION ALL SELECT (SELECT max(id) FROM k) + row_number() OVER (ORDER BY url), url FROM n",
}
QUERIES |= report.QUERIES | cases.QUERIES
ORACLES |= report.ORACLES | cases.ORACLES
