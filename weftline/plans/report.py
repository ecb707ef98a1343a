"""Queries of the corpus report, and their SQL. documents stand for raw blobs and documents (lang as the type), events for the crawl log, pages for the queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import links, text
from ..operators import crawl, stats

_WORDS = r"len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> ''))"


def _raw(spark: SparkSession, sf: str) -> DataFrame:
    d = spark.read.parquet(f"{sf}/documents.parquet")
    n, k = text.word_count(F.col("text")), F.col("doc_id") % 10
    return d.select(
        F.sha2("text", 256).alias("content_sha256"), F.col("lang").alias("source_type"), F.octet_length("text").cast("bigint").alias("bytes"), (n >= 50).alias("quality_ok"), F.when(k == 3, F.concat(F.repeat(F.lit("x"), 150), F.col("lang"))).alias("extract_error"),
        F.when(k == 4, "pending").otherwise("done").alias("extract_state"), F.concat(F.lit("2026-01-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")).alias("first_seen_at"), "doc_id",
    )


_RAW = f"""raw AS (SELECT sha256(text) AS content_sha256, lang AS source_type, strlen(text)::BIGINT AS bytes, {_WORDS} >= 50 AS quality_ok, CASE WHEN doc_id % 10 = 3 THEN repeat('x', 150) || lang END AS extract_error,
    CASE WHEN doc_id % 10 = 4 THEN 'pending' ELSE 'done' END AS extract_state, '2026-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS first_seen_at, doc_id FROM documents)"""


def _docs(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    return d.select(text.word_count(F.col("text")).alias("word_count"), (F.col("doc_id") % 9 != 0).alias("present"), F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("department"), F.concat(F.lit("2026-02-"), F.lpad((F.col("doc_id") % 28 + 1).cast("string"), 2, "0")).alias("updated_at"))


_DOCS = f"""docs AS (SELECT {_WORDS} AS word_count, doc_id % 9 <> 0 AS present, CASE WHEN doc_id % 5 <> 0 THEN source END AS department, '2026-02-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS updated_at FROM documents)"""


def _queue(spark, sf):
    p = spark.read.parquet(f"{sf}/pages.parquet")
    state = F.element_at(F.array(*map(F.lit, ("done", "error", "pending", "in_progress"))), (F.col("page_id") % 4 + 1).cast("int"))
    return p.select("url", state.alias("work_state"), (F.col("page_id") % 7 != 0).alias("present"), F.when(F.col("page_id") % 3 == 0, F.lit("2026-01-02")).alias("last_checked_at"), (F.col("page_id") % 5).cast("string").alias("site"), F.concat(F.lit("2026-03-"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0")).alias("first_seen_at"))


_QUEUE = """queue AS (SELECT url, ['done', 'error', 'pending', 'in_progress'][(page_id % 4 + 1)::INT] AS work_state, page_id % 7 <> 0 AS present, CASE WHEN page_id % 3 = 0 THEN '2026-01-02' END AS last_checked_at, (page_id % 5)::VARCHAR AS site,
    '2026-03-' || lpad((page_id % 28 + 1)::VARCHAR, 2, '0') AS first_seen_at FROM pages)"""


def _log(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    return e.select(F.when(F.col("event_id") % 11 != 0, F.element_at(F.array(*map(F.lit, (200, 304, 404, 429, 500, 503, 410, 301, 302, 403, 401, 504, 502, 308))), (F.col("event_id") % 14 + 1).cast("int"))).alias("status"), F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("failed with "), F.col("event_type"), F.repeat(F.lit("."), 100), (F.col("event_id") % 4).cast("string"))).alias("error"), F.element_at(F.array(*map(F.lit, ("new", "changed", "unchanged", "removed", "error", "skipped"))), (F.col("user_id") % 6 + 1).cast("int")).alias("outcome"), (F.col("event_id") % 5).cast("string").alias("site"))


_LOG = """log AS (SELECT CASE WHEN event_id % 11 <> 0 THEN [200, 304, 404, 429, 500, 503, 410, 301, 302, 403, 401, 504, 502, 308][(event_id % 14 + 1)::INT] END AS status, CASE WHEN event_id % 3 = 0 THEN 'failed with ' || event_type || repeat('.', 100) || (event_id % 4) END AS error,
    ['new', 'changed', 'unchanged', 'removed', 'error', 'skipped'][(user_id % 6 + 1)::INT] AS outcome, (event_id % 5)::VARCHAR AS site FROM events)"""


def raw_by_type(spark, sf):
    return stats.raw_by_type(_raw(spark, sf))


def raw_totals(spark, sf):
    return stats.raw_totals(_raw(spark, sf))


def word_range(spark, sf):
    return stats.word_range(_docs(spark, sf))


def freshness(spark, sf):
    return stats.freshness(_queue(spark, sf), _docs(spark, sf), _raw(spark, sf))


def extract_errors(spark, sf):
    return stats.extract_errors(_raw(spark, sf))


def log_statuses(spark, sf):
    return stats.statuses(_log(spark, sf))


def log_errors(spark, sf):
    return stats.errors(_log(spark, sf))


def log_outcomes(spark, sf):
    return crawl.outcome_counts(_log(spark, sf))


def state_counts(spark, sf):
    return stats.state_counts(_queue(spark, sf), _docs(spark, sf), _raw(spark, sf))


def documents_by_class(spark, sf):
    return stats.by_class(_docs(spark, sf), "department")


def pending_urls(spark, sf):
    return crawl.count_pending(_queue(spark, sf), only_new=True)


def gate_candidates(spark, sf):
    raw = _raw(spark, sf)
    queue = raw.select("content_sha256", (F.col("doc_id") % 3 != 0).alias("present"))
    return stats.candidates(queue, raw.groupBy("content_sha256").agg(F.max("quality_ok").alias("quality_ok")))


def external_hosts(spark, sf):
    """The links of pages with every absolute path put on one of several hosts, some of which are the page's own."""
    p = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", F.concat(F.lit("https://own.example/"), "page_id").alias("url"), F.regexp_replace("html", 'href="/', 'href="https://Host1.example:8080/').alias("html"))
    return stats.top_external(links.link_edges(p))


QUERIES = {f.__name__: f for f in (raw_by_type, raw_totals, word_range, freshness, extract_errors, log_statuses, log_errors, log_outcomes, state_counts, documents_by_class, pending_urls, gate_candidates, external_hosts)}
ORACLES = {
    "raw_by_type": f"WITH {_RAW} SELECT source_type, count(*) AS n, sum(bytes)::BIGINT AS bytes FROM raw GROUP BY 1",
    "raw_totals": f"WITH {_RAW} SELECT count(*) AS raw, sum(bytes)::BIGINT AS bytes, count(*) FILTER (quality_ok) AS quality_ok, count(*) FILTER (NOT quality_ok) AS quality_bad, count(extract_error) AS errored, count(*) FILTER (extract_state = 'pending') AS pending FROM raw",
    "word_range": f"WITH {_DOCS} SELECT count(*) AS n, min(word_count)::INT AS least, max(word_count)::INT AS most, count(*) FILTER (word_count < 50) AS below FROM docs WHERE present",
    "freshness": f"WITH {_RAW}, {_DOCS}, {_QUEUE} SELECT 'queue_first_seen' AS what, min(first_seen_at) AS first, max(first_seen_at) AS last FROM queue UNION ALL SELECT 'documents_updated', min(updated_at), max(updated_at) FROM docs UNION ALL SELECT 'raw_first_seen', min(first_seen_at), max(first_seen_at) FROM raw",
    "extract_errors": f"WITH {_RAW} SELECT substr(extract_error, 1, 140) AS error, count(*) AS n FROM raw WHERE extract_error IS NOT NULL GROUP BY extract_error ORDER BY n DESC, extract_error LIMIT 12",
    "log_statuses": f"WITH {_LOG} SELECT coalesce(status, 0)::INT AS status, count(*) AS n FROM log GROUP BY 1 ORDER BY n DESC, 1 LIMIT 12",
    "log_errors": f"WITH {_LOG} SELECT substr(error, 1, 100) AS error, count(*) AS n FROM log WHERE error <> '' GROUP BY log.error ORDER BY n DESC, log.error LIMIT 10",
    "log_outcomes": f"WITH {_LOG} SELECT site, " + ", ".join(f"count(*) FILTER (outcome = '{o}') AS {o}" for o in ("new", "changed", "unchanged", "removed", "error", "skipped")) + " FROM log GROUP BY site",
    "state_counts": f"""WITH {_RAW}, {_DOCS}, {_QUEUE}, q AS (SELECT count(*) FILTER (work_state = 'pending') AS queue_pending, count(*) FILTER (work_state = 'done') AS queue_done, count(*) FILTER (work_state = 'error') AS queue_error, count(*) FILTER (present) AS urls_present, count(*) FILTER (NOT present) AS urls_removed FROM queue),
        r AS (SELECT count(*) FILTER (extract_state = 'pending') AS raw_pending FROM raw), d AS (SELECT count(*) FILTER (present) AS documents, count(*) FILTER (NOT present) AS documents_removed, count(*) FILTER (present AND department IS NULL) AS unclassified FROM docs) SELECT * FROM q, r, d""",
    "documents_by_class": f"WITH {_DOCS} SELECT department, count(*) AS n FROM docs WHERE present AND department IS NOT NULL GROUP BY 1",
    "pending_urls": f"WITH {_QUEUE} SELECT count(*) AS pending FROM queue WHERE work_state = 'pending' AND last_checked_at IS NULL",
    "gate_candidates": f"WITH {_RAW}, r AS (SELECT content_sha256, max(quality_ok::INT) AS ok FROM raw GROUP BY 1) SELECT count(*) AS candidates FROM raw JOIN r USING (content_sha256) WHERE doc_id % 3 <> 0 AND ok = 1",
    "external_hosts": "WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\s[^>]*?href=\"([^\"#]*)', 1)) AS href FROM pages) SELECT 'host1.example:8080' AS host, count(*) AS n FROM (SELECT DISTINCT page_id, href FROM h WHERE href LIKE '/%')",
}
