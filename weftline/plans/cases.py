"""Queries over literal rows, for branches that the driver's tables never reach. Inputs are VALUES that Spark and DuckDB read alike; the expected rows are written out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links, urls
from ..operators import crawl, extract, merge
from ..sources import sitemap
from ..sources.tables import SCHEMAS

NOW = "2026-01-02"
_S = "cast(null as string)"


def _values(spark: SparkSession, rows: str, columns: str) -> DataFrame:
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


#: url, final_url, status, type, body, etag, then what was known: digest of, present, etag.
_FETCHED = f"""('https://x.de/01', 'https://x.de/01', 304, 'text/html', '', 'e2', 'a', true, 'e1'), ('https://x.de/02', 'https://x.de/02', 200, 'text/html', '', {_S}, 'a', true, 'e1'),
    ('https://x.de/03', 'https://x.de/03', 200, 'text/html', '', {_S}, {_S}, true, {_S}), ('https://x.de/04', 'https://x.de/04', 404, 'text/html', 'gone', {_S}, 'a', true, 'e1'), ('https://x.de/05', 'https://x.de/05', 410, {_S}, {_S}, {_S}, 'a', true, 'e1'),
    ('https://x.de/06', 'https://x.de/06', 503, 'text/html', 'busy', {_S}, 'a', true, 'e1'), ('https://x.de/07', 'https://y.de/', 200, 'text/html', 'a', 'e2', 'a', true, 'e1'), ('https://x.de/08', 'https://x.de/08', 201, 'image/png', 'a', {_S}, {_S}, true, {_S}),
    ('https://x.de/09', 'https://x.de/09', 200, 'text/html', 'a', 'e2', {_S}, true, {_S}), ('https://x.de/10', 'https://x.de/10', 200, 'text/html', 'a', {_S}, 'a', true, 'e1'), ('https://x.de/11', 'https://x.de/11', 200, 'text/html', 'b', {_S}, 'a', true, 'e1'),
    ('https://x.de/12', 'https://x.de/12', 200, 'text/html', 'a', 'e2', 'a', false, {_S}), ('https://x.de/13', 'https://a.x.de/13', 200, 'application/x-pdf', 'a', {_S}, {_S}, true, {_S})"""
_EXPECTED = [
    ("01", "unchanged", "html"), ("02", "unchanged", "html"), ("03", "skipped", "html"), ("04", "removed", "html"), ("05", "removed", "html"), ("06", "error", "html"), ("07", "skipped", "html"), ("08", "skipped", "other"), ("09", "new", "html"),
    ("10", "unchanged", "html"), ("11", "changed", "html"), ("12", "changed", "html"), ("13", "new", "pdf"),
]
#: url, state, status, etag, digest of, present, changed at.
_MARKED = """('01', 'done', 304, 'e2', 'a', true, NULL), ('02', 'done', 200, 'e1', 'a', true, NULL), ('03', 'done', 200, NULL, NULL, true, NULL), ('04', 'done', 404, NULL, 'a', false, '2026-01-02'), ('05', 'done', 410, NULL, 'a', false, '2026-01-02'), ('06', 'error', 503, 'e1', 'a', true, NULL),
    ('07', 'done', 200, 'e2', 'a', true, NULL), ('08', 'done', 200, NULL, NULL, true, NULL), ('09', 'done', 200, 'e2', 'a', true, '2026-01-02'), ('10', 'done', 200, 'e1', 'a', true, NULL), ('11', 'done', 200, NULL, 'b', true, '2026-01-02'), ('12', 'done', 200, 'e2', 'a', true, '2026-01-02'), ('13', 'done', 200, NULL, 'a', true, '2026-01-02')"""


def _outcomes(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    t = _values(spark, _FETCHED, "url, final_url, status, content_type, body, etag, known, was, known_etag")
    got = t.select("url", "final_url", "status", "content_type", F.col("body").cast("binary").alias("data"), "etag", F.lit(None).cast("string").alias("last_modified"), F.when(F.col("status") == 503, "busy").alias("error"))
    queue = t.select("url", F.sha2("known", 256).alias("content_sha256"), F.col("was").alias("present"), F.col("known_etag").alias("etag"), F.lit(None).cast("string").alias("last_modified"))
    return crawl.outcomes(got, queue, F.lit("x.de")), queue


def outcome_branches(spark, sf):
    return _outcomes(spark)[0].select(F.substring("url", -2, 2).alias("page"), "outcome", "kind")


def mark_urls(spark, sf):
    got, known = _outcomes(spark)
    empty = spark.createDataFrame([], SCHEMAS["queue"])
    queue = empty.unionByName(known.withColumn("work_state", F.lit("pending")), allowMissingColumns=True).select(*empty.columns)
    return crawl.mark(queue, got, NOW).select(F.substring("url", -2, 2).alias("page"), "work_state", "http_status", "etag", "content_sha256", "present", "last_changed_at")


_LINKS = """('plain', '/a?x=1&section=3&copy=2'), ('amp', '/a?x=1&amp;y=2'), ('named', '/&lt;b'), ('legacy', '/x&copy'), ('unknown', '/x&nothing;y'), ('mail', 'mailto:a@b'), ('script', ' JavaScript:go()'), ('other', '//Other.de:443/x#f'), ('up', '../up'), ('umlaut', '/für')"""


def link_cases(spark, sf):
    t = _values(spark, _LINKS, "name, href")
    p = t.select(F.concat(F.lit("https://x.de/d/"), "name").alias("url"), F.concat(F.lit('<A HREF="'), "href", F.lit('">l</a>')).alias("html"))
    return links.link_edges(p).select(F.substring_index("src", "/", -1).alias("name"), "dst", "in_domain")


_ENTITIES = """('a', '<url><loc>https://x.de/?b=1&amp;section=3&copy=2</loc><lastmod>2024</lastmod></url>'), ('b', '<URL><LOC> https://x.de/&#38;&#x41; </LOC></URL>'), ('c', '<url><lastmod>2024</lastmod></url>'), ('d', '<url><loc><![CDATA[https://x.de/c]]></loc></url><url><loc>https://x.de/&nbsp;&#1114112;</loc>'), ('e', '<url><loc>https://x.de/&eacute;&apos;</loc></url>')"""


def sitemap_cases(spark, sf):
    return sitemap.entries(_values(spark, _ENTITIES, "name, xml")).select("url", "lastmod")


_KINDS = f"""('application/x-pdf', '/a'), ('text/html; charset=utf-8', '/a.zip'), ('application/xhtml+xml', '/a'), ('text/plain', '/a'), ('image/png', '/a'), ({_S}, '/a.PDF?x'), ({_S}, '/a.json'), ({_S}, '/a.css'), ({_S}, '/a.dmg'), ('', '/a')"""


def kind_cases(spark, sf):
    t = _values(spark, _KINDS, "type, path")
    return t.select(F.coalesce("type", F.lit("-")).alias("type"), "path", urls.route_kind(F.col("type"), F.concat(F.lit("https://x.de"), "path")).alias("kind"))


def edge_insert(spark, sf):
    known = _values(spark, "('a', 'b', 's', true, 1L, 'old')", "src, dst, site, in_domain, depth, first_seen_at")
    new = _values(spark, "('a', 'b', 's', true, 0L, 'new'), ('a', 'c', 's', false, 3L, 'new'), ('a', 'c', 's', false, 2L, 'new'), ('b', 'a', 's', true, 2L, 'new')", "src, dst, site, in_domain, depth, first_seen_at")
    return crawl.insert_edges(known, new)


def requeue_modes(spark, sf):
    q = _values(spark, f"('a', 'done', 200, true), ('b', 'done', 404, false), ('c', 'error', 503, true), ('d', 'error', 403, true), ('e', 'in_progress', {_S.replace('string', 'int')}, true), ('f', 'error', 0, true)", "url, work_state, http_status, present").selectExpr("*", "'e' etag", "'m' last_modified")
    out = None
    for mode, retry in (("all", True), ("changed-only", True), ("changed-only", False), ("new-only", False), ("force-full", True)):
        one = crawl.requeue(q, mode, retry).groupBy(F.lit(mode).alias("mode"), F.lit(retry).alias("retry")).agg(F.array_join(F.array_sort(F.collect_list(F.when(F.col("work_state") == "pending", F.col("url")))), "").alias("pending"), F.count("etag").alias("validators"))
        out = one if out is None else out.unionByName(one)
    return out


_SITE = [
    ("https://x.de/", '<a href="/a">a</a><a href="/b">b</a><a href="https://z.de/">z</a>'), ("https://x.de/a", '<a href="/c">c</a><a href="/calendar/view.php">t</a>'), ("https://x.de/b", "b"), ("https://x.de/c", "c"), ("https://x.de/s", "from the sitemap"),
]


def crawl_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(queue, answers of the server, sitemap, cached blobs): / is not modified, a is known with other bytes, gone answers 404, fresh error is retried, b and c are new."""
    empty = spark.createDataFrame([], SCHEMAS["queue"])
    known = _values(spark, f"('https://x.de/', sha2('{_SITE[0][1]}', 256), 'done', 200, 'e', 0L, 'x'), ('https://x.de/a', sha2('old', 256), 'done', 200, {_S}, 1L, 'x'), ('https://x.de/gone', sha2('g', 256), 'done', 200, {_S}, 1L, 'x'), ('https://x.de/busy', {_S}, 'error', 503, {_S}, 1L, 'x')", "url, content_sha256, work_state, http_status, etag, depth, last_checked_at")
    queue = empty.unionByName(known.withColumns({"present": F.lit(True), "site": F.lit("x.de")}), allowMissingColumns=True).select(*empty.columns)
    pages = spark.createDataFrame([(u, 304 if u == "https://x.de/" else 200, None if u == "https://x.de/" else bytearray(h.encode())) for u, h in _SITE] + [("https://x.de/gone", 404, None), ("https://x.de/busy", 503, None)], "url string, status int, data binary")
    answers = pages.select("url", F.col("url").alias("final_url"), "status", F.lit("text/html").alias("content_type"), "data", F.lit(None).cast("string").alias("etag"), F.lit(None).cast("string").alias("last_modified"), F.when(F.col("status") >= 400, "status").alias("error"))
    sitemap_ = spark.createDataFrame([("https://x.de/s", "2026", "x.de")], "url string, lastmod string, site string")
    blobs = spark.createDataFrame([(_SITE[0][1],)], "html string").select(F.sha2("html", 256).alias("content_sha256"), F.lit("html").alias("source_type"), F.col("html").cast("binary").alias("data"))
    return queue, answers, sitemap_, blobs


def _kept(name: str, k: int, df: DataFrame) -> DataFrame:
    """Stands for a written table: the few literal rows of these cases."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def crawled(spark: SparkSession, mode: str = "all") -> tuple[DataFrame, DataFrame, DataFrame]:
    queue, answers, listed, blobs = crawl_tables(spark)
    seeds = spark.createDataFrame([("https://x.de/", "x.de")], "url string, site string")
    return crawl.run(queue, seeds, lambda wave: answers.join(wave.select("url"), "url"), _kept, NOW, mode, sitemap=listed, blobs=blobs)


def crawl_run(spark, sf):
    queue, got, _ = crawled(spark)
    return queue.join(got.select("url", "outcome"), "url", "left").select("url", "work_state", "depth", "present", "outcome", "sitemap_lastmod")


def crawl_edges(spark, sf):
    return crawled(spark)[2].select("src", "dst", "in_domain", "trap", "depth")


def _extracted(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    empty = spark.createDataFrame([], SCHEMAS["raw_docs"])
    body = "<html><head><title>T</title></head><body><h1>Head</h1><p>" + "word " * 60 + "</p></body></html>"
    rows = spark.createDataFrame([("good", "html", body, "pending"), ("short", "html", "<p>too short</p>", "error"), ("none", "html", "", "pending"), ("bad", "pdf", "x", "in_progress"), ("old", "html", body, "done")], "content_sha256 string, source_type string, body string, extract_state string")
    raw = empty.unionByName(rows.select("content_sha256", "source_type", F.col("body").cast("binary").alias("data"), "extract_state"), allowMissingColumns=True).select(*empty.columns)
    queue = spark.createDataFrame([("https://x.de/p?v=1", "good", True), ("https://x.de/p", "good", True), ("https://x.de/q", "good", False), ("https://x.de/s", "short", True), ("https://x.de/o", "old", True)], "url string, content_sha256 string, present boolean").withColumn("site", F.lit("x.de"))
    snapshot = spark.createDataFrame([], "url string, " + ", ".join(f"{c} string" for c in merge.CONTENT) + ", present boolean, revision int, first_indexed_at string, updated_at string")
    return extract.run(raw, queue, snapshot, NOW, _kept)


def extract_states(spark, sf):
    return _extracted(spark)[0].select("content_sha256", "extract_state", F.coalesce("word_count", F.lit(-1)).alias("word_count"), "quality_ok", "reject_reason", F.substring_index("extract_error", ":", 1).alias("extract_error"), "title")


def extract_documents(spark, sf):
    return _extracted(spark)[1].select("url", "content_sha256", "title", "present", "revision", "outcome", "updated_at")


QUERIES = {f.__name__: f for f in (outcome_branches, mark_urls, link_cases, sitemap_cases, kind_cases, edge_insert, requeue_modes, crawl_run, crawl_edges, extract_states, extract_documents)}
ORACLES = {
    "outcome_branches": "SELECT * FROM (VALUES " + ", ".join(map(str, _EXPECTED)) + ") AS t(page, outcome, kind)",
    "mark_urls": f"SELECT page, work_state, http_status, etag, sha256(known) AS content_sha256, present, last_changed_at FROM (VALUES {_MARKED}) AS t(page, work_state, http_status, etag, known, present, last_changed_at)",
    "link_cases": "SELECT * FROM (VALUES ('plain', 'https://x.de/a?x=1&section=3&copy=2', true), ('amp', 'https://x.de/a?x=1&y=2', true), ('named', 'https://x.de/%3Cb', true), ('legacy', 'https://x.de/x%C2%A9', true), ('unknown', 'https://x.de/x&nothing;y', true), ('other', 'https://other.de/x', false), ('up', 'https://x.de/up', true), ('umlaut', 'https://x.de/f%C3%BCr', true)) AS t(name, dst, in_domain)",
    "sitemap_cases": "SELECT * FROM (VALUES ('https://x.de/?b=1&section=3&copy=2', '2024'), ('https://x.de/&A', NULL), ('https://x.de/c', NULL), ('https://x.de/&eacute;''', NULL)) AS t(url, lastmod)",
    "kind_cases": "SELECT * FROM (VALUES ('application/x-pdf', '/a', 'pdf'), ('text/html; charset=utf-8', '/a.zip', 'html'), ('application/xhtml+xml', '/a', 'html'), ('text/plain', '/a', 'html'), ('image/png', '/a', 'other'), ('-', '/a.PDF?x', 'pdf'), ('-', '/a.json', 'other'), ('-', '/a.css', 'other'), ('-', '/a.dmg', 'html'), ('', '/a', 'html')) AS t(type, path, kind)",
    "edge_insert": "SELECT * FROM (VALUES ('a', 'b', 's', true, 1::BIGINT, 'old'), ('a', 'c', 's', false, 2::BIGINT, 'new'), ('b', 'a', 's', true, 2::BIGINT, 'new')) AS t(src, dst, site, in_domain, depth, first_seen_at)",
    "requeue_modes": "SELECT mode, retry, pending, validators::BIGINT AS validators FROM (VALUES ('all', true, 'acef', 6), ('changed-only', true, 'cef', 6), ('changed-only', false, 'e', 6), ('new-only', false, 'e', 6), ('force-full', true, 'acef', 0)) AS t(mode, retry, pending, validators)",
    "crawl_run": "SELECT url, work_state, depth::BIGINT AS depth, present, outcome, sitemap_lastmod FROM (VALUES ('https://x.de/', 'done', 0, true, 'unchanged', NULL), ('https://x.de/a', 'done', 1, true, 'changed', NULL), ('https://x.de/gone', 'done', 1, false, 'removed', NULL), ('https://x.de/busy', 'error', 1, true, 'error', NULL), ('https://x.de/c', 'done', 2, true, 'new', NULL), ('https://x.de/s', 'done', 0, true, 'new', '2026')) AS t(url, work_state, depth, present, outcome, sitemap_lastmod)",
    "crawl_edges": "SELECT src, dst, in_domain, trap, depth::BIGINT AS depth FROM (VALUES ('https://x.de/', 'https://x.de/a', true, false, 1), ('https://x.de/', 'https://x.de/b', true, false, 1), ('https://x.de/', 'https://z.de/', false, false, 1), ('https://x.de/a', 'https://x.de/c', true, false, 2), ('https://x.de/a', 'https://x.de/calendar/view.php', true, true, 2)) AS t(src, dst, in_domain, trap, depth)",
    "extract_states": "SELECT * FROM (VALUES ('good', 'done', 61, true, NULL, NULL, 'T'), ('short', 'rejected', 2, false, 'too short: 2 words', NULL, NULL), ('none', 'rejected', 0, false, 'empty', NULL, NULL), ('bad', 'error', 0, false, NULL, 'KeyError', NULL), ('old', 'done', -1, NULL, NULL, NULL, NULL)) AS t(content_sha256, extract_state, word_count, quality_ok, reject_reason, extract_error, title)",
    "extract_documents": "SELECT * FROM (VALUES ('https://x.de/p', 'good', 'T', true, 1, 'new', '2026-01-02')) AS t(url, content_sha256, title, present, revision, outcome, updated_at)",
}
