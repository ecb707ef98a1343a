"""Extraction of raw blobs: claim what is pending, extract, gate, keep the state, and turn accepted blobs into documents.

A raw table has content_sha256, source_type, bytes, data, extract_state (pending, in_progress, done, error,
rejected) and the columns of SAVED. Extractors are Python callables from bytes to a dict of title, text, markdown, lang and
metadata, or None; a failure is a row's extract_error, never the job's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls
from ..sources.pages import extract_html
from . import merge, quality, taxonomy

SAVED = "title string, text string, markdown string, lang string, metadata map<string,string>, word_count int, quality_ok boolean, reject_reason string, extract_error string, extracted_at string"
_OUT = "content_sha256 string, title string, text string, markdown string, lang string, metadata map<string,string>, extract_error string"
EXTRACTORS: dict[str, Callable[[bytes], dict | None]] = {"html": extract_html}


def recover(raw: DataFrame, source_type: str | None = None) -> DataFrame:
    """Start of a run: interrupted and failed blobs are pending again."""
    own = F.lit(True) if source_type is None else F.col("source_type") == source_type
    again = own & F.col("extract_state").isin("in_progress", "error")
    return raw.withColumns({"extract_error": F.when(own & (F.col("extract_state") == "error"), None).otherwise(F.col("extract_error")), "extract_state": F.when(again, "pending").otherwise(F.col("extract_state"))})


def count_pending(raw: DataFrame, source_type: str | None = None) -> DataFrame:
    """(pending): blobs that wait for extraction."""
    return raw.agg(F.count_if((F.col("extract_state") == "pending") & (F.lit(True) if source_type is None else F.col("source_type") == source_type)).alias("pending"))


def urls_for_content(queue: DataFrame, digests: DataFrame) -> DataFrame:
    """Rows of the queue that are present and hold one of the digests."""
    return queue.where("present").join(digests.select("content_sha256").distinct(), "content_sha256", "left_semi")


def apply_extractors(blobs: DataFrame, extractors: dict[str, Callable[[bytes], dict | None]] | None = None) -> DataFrame:
    """(content_sha256, title, text, markdown, lang, metadata, extract_error) of blobs (content_sha256, source_type, data), one row each."""
    table = EXTRACTORS if extractors is None else extractors

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                doc, error = None, None
                try:
                    doc = table[r.source_type](bytes(r.data))
                except Exception as e:  # a blob that can't be read is a result
                    error = f"{type(e).__name__}: {e}"
                doc = doc or {}
                meta = {k: str(v) for k, v in (doc.get("metadata") or {}).items() if v is not None}
                rows.append((r.content_sha256, doc.get("title"), doc.get("text"), doc.get("markdown"), doc.get("lang"), meta or None, error))
            yield pd.DataFrame(rows, columns=["content_sha256", "title", "text", "markdown", "lang", "metadata", "extract_error"])

    return blobs.select("content_sha256", "source_type", "data").mapInPandas(run, _OUT)


def extract(raw: DataFrame, now: str, extractors: dict[str, Callable[[bytes], dict | None]] | None = None, min_words: int = 50, source_type: str | None = None) -> DataFrame:
    """The next raw table: pending blobs (of one source type, if given) are extracted and gated; all others stay as they are.

    Each distinct blob is extracted once. States: error with its text, rejected with its reason, or done. Write the result
    before it is used twice, else the extractors run again.
    """
    pending = (F.col("extract_state") == "pending") & (F.lit(True) if source_type is None else F.col("source_type") == source_type)
    got = apply_extractors(raw.where(pending), extractors)
    reason = F.when(F.col("text").isNull(), "empty").otherwise(quality.reject_reason(F.col("text"), F.col("markdown"), min_words))
    got = got.withColumn("reason", F.when(F.col("extract_error").isNull(), reason))
    got = got.select(
        "content_sha256", "title", "text", "markdown", "lang", "metadata", tx.word_count(F.col("text")).alias("word_count"), F.coalesce(F.col("reason") == "ok", F.lit(False)).alias("quality_ok"),
        F.when(F.col("reason") != "ok", F.col("reason")).alias("reject_reason"), "extract_error", F.lit(now).alias("extracted_at"),
        F.when(F.col("extract_error").isNotNull(), "error").when(F.col("reason") == "ok", "done").otherwise("rejected").alias("extract_state"),
    )
    columns = [c for c in raw.columns if c not in got.columns or c == "content_sha256"]
    done = raw.where(pending).select(*columns).join(got, "content_sha256").select(*raw.columns)
    return raw.where(~F.coalesce(pending, F.lit(False))).unionByName(done)


def documents_of(extracted: DataFrame, queue: DataFrame) -> DataFrame:
    """What merge.upsert takes in: a row for each present URL of each accepted blob. A missing title comes from the URL; the final URL is the URL until a backfill."""
    ok = extracted.where("extract_state = 'done'").select("content_sha256", "source_type", "title", "text", "lang", "markdown", "metadata", "word_count")
    held = urls_for_content(queue, ok).select("url", "site", "content_sha256")
    j = held.join(ok, "content_sha256")
    return j.select("url", F.col("url").alias("final_url"), "site", "source_type", "content_sha256", F.coalesce("title", urls.title_from_url(F.col("url"))).alias("title"), "text", "lang", tx.text_hash(F.col("text")).alias("text_sha256"), "metadata", "word_count")


def run(raw: DataFrame, queue: DataFrame, snapshot: DataFrame, now: str, save: Callable[[str, int, DataFrame], DataFrame], extractors: dict[str, Callable[[bytes], dict | None]] | None = None, min_words: int = 50) -> tuple[DataFrame, DataFrame]:
    """One extraction run: (raw table, document snapshot with `outcome`) after it. A rejected blob leaves the documents made from its URL before as they are."""
    before = recover(raw)
    fresh = before.where("extract_state = 'pending'").select("content_sha256")
    after = save("raw", 0, extract(before, now, extractors, min_words))
    new = after.join(fresh, "content_sha256", "left_semi")
    return after, merge.upsert(snapshot, documents_of(new, queue), now)


def outcome_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(indexed, rejected, error): what became of the blobs that were pending before."""
    j = after.join(before.where("extract_state = 'pending'").select("content_sha256"), "content_sha256", "left_semi")
    return j.agg(F.count_if(F.col("extract_state") == "done").alias("indexed"), F.count_if(F.col("extract_state") == "rejected").alias("rejected"), F.count_if(F.col("extract_state") == "error").alias("error"))


def reclassify(docs: DataFrame, rules: taxonomy.Taxonomy) -> DataFrame:
    """Every document, removed ones too, with its classification of today; stamps stay. docs: url, title and, if there, a metadata map with a description."""
    about = F.col("metadata")["description"] if "metadata" in docs.columns else F.lit(None).cast("string")
    c = taxonomy.classify(F.col("url"), F.col("title"), about, rules)
    return docs.withColumn("c", c).withColumns({k: F.col("c")[k] for k in ("campus", "department", "program", "department_source", "version")}).drop("c")
