"""Corpus report: exact counts, histograms, nearest-rank percentiles, top lists and findings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import urls

BUCKETS = (0, 50, 100, 250, 500, 1000, 2500, 5000)
PERCENTS = (10, 25, 50, 75, 90, 99)


def histogram(docs: DataFrame, words: str = "word_count") -> DataFrame:
    """(bucket, low, n): documents in half-open ranges of words; empty ranges have 0."""
    ends = [*BUCKETS[1:], None]
    names = [f"{a}-{b - 1}" if b else f"{a}+" for a, b in zip(BUCKETS, ends)]
    counts = docs.agg(*(F.count_if((F.col(words) >= a) & (F.lit(True) if b is None else F.col(words) < b)).alias(f"c{i}") for i, (a, b) in enumerate(zip(BUCKETS, ends))))
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("bucket"), F.lit(a).alias("low"), F.col(f"c{i}").alias("n")) for i, (n, a) in enumerate(zip(names, BUCKETS)))))
    return counts.select(rows.alias("r")).select("r.*")


def percentiles(docs: DataFrame, value: str = "word_count", percents=PERCENTS) -> DataFrame:
    """(percent, value): the element at index min(n - 1, floor(p / 100 * n)) of the sorted values.

    Values are counted first, so what is sorted in one place is the distinct values.
    """
    counts = docs.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    run = counts.withColumn("upto", F.sum("n").over(W.orderBy("value"))).withColumn("total", F.sum("n").over(W.partitionBy()))
    wanted = run.withColumn("percent", F.explode(F.array(*map(F.lit, percents))))
    index = F.least(F.col("total") - 1, F.floor(F.col("percent") * F.col("total") / 100))
    return wanted.where((F.col("upto") > index) & (F.col("upto") - F.col("n") <= index)).select("percent", "value")


def top(df: DataFrame, key: Column, name: str, n: int, cut: int | None = None) -> DataFrame:
    """The n most frequent keys, ties by key; long ones are cut after they were counted."""
    t = df.groupBy(key.alias(name)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.col(name).asc_nulls_first()).limit(n)
    return t.withColumn(name, F.substring(name, 1, cut)) if cut else t


def pivot_states(queue: DataFrame, by: Column, name: str) -> DataFrame:
    """Counts by state, a column for each."""
    state = lambda s: F.count_if(F.col("work_state") == s).alias(s)
    return queue.groupBy(by.alias(name)).agg(F.count("*").alias("total"), *(state(s) for s in ("done", "error", "pending", "in_progress")))


def coverage(queue: DataFrame, docs: DataFrame, sites: list[str]) -> DataFrame:
    """Per site documents, words, average, states and error rate; configured sites first and in order."""
    d = docs.where("present").groupBy("site").agg(F.count("*").alias("docs"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"))
    j = pivot_states(queue, F.col("site"), "site").join(d, "site", "full_outer")
    place = F.array_position(F.array(*map(F.lit, sites)), F.col("site")) if sites else F.lit(0)
    j = j.fillna(0).withColumns({"average": F.when(F.col("docs") > 0, F.bround(F.col("words") / F.col("docs"))).otherwise(0.0), "tried": F.col("done") + F.col("error")})
    return j.withColumn("error_rate", F.when(F.col("tried") > 0, F.col("error") / F.col("tried")).otherwise(0.0)).orderBy(F.when(place > 0, place).otherwise(1 << 30), "site").drop("tried")


def error_breakdown(log: DataFrame, most: int = 6) -> DataFrame:
    """(site, errors, statuses): the most frequent statuses of each site's errors as text, such as 404:3, sites with most errors first."""
    n = log.where("outcome = 'error'").groupBy("site", F.coalesce("status", F.lit(0)).alias("status")).agg(F.count("*").alias("n"))
    w = W.partitionBy("site")
    n = n.withColumn("k", F.row_number().over(w.orderBy(F.desc("n"), "status"))).withColumn("errors", F.sum("n").over(w)).where(F.col("k") <= most)
    shown = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "status", "n"))), lambda x: F.concat(x["status"].cast("string"), F.lit(":"), x["n"].cast("string"))), ", ")
    return n.groupBy("site").agg(F.first("errors").alias("errors"), shown.alias("statuses")).orderBy(F.desc("errors"), "site")


def link_totals(edges: DataFrame) -> DataFrame:
    return edges.agg(F.count("*").alias("total"), F.count_if("in_domain").alias("in_domain"), F.count_if(~F.col("in_domain")).alias("external"), F.countDistinct("src").alias("distinct_src"), F.countDistinct("dst").alias("distinct_dst"))


def without_links(docs: DataFrame, edges: DataFrame) -> DataFrame:
    """Documents without an outgoing edge; all if there are no edges."""
    return docs.join(edges.select(F.col("src").alias("url")).distinct(), "url", "left_anti")


def top_external(edges: DataFrame, n: int = 20) -> DataFrame:
    return top(edges.where(~F.col("in_domain") & (urls.netloc(F.col("dst")) != "")), urls.netloc(F.col("dst")), "host", n)


def totals(docs: DataFrame) -> DataFrame:
    """Per source type: documents, words, longest, average."""
    g = docs.where("present").groupBy("source_type").agg(F.count("*").alias("docs"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"), F.max("word_count").alias("longest"))
    return g.withColumn("average", F.col("words") / F.col("docs"))


def host_table(queue: DataFrame, n: int = 25) -> DataFrame:
    """(host, urls, done, error, pending) of the n hosts, with port, that have most URLs."""
    t = pivot_states(queue, urls.netloc(F.col("url")), "host").withColumnRenamed("total", "urls").drop("in_progress")
    return t.orderBy(F.desc("urls"), "host").limit(n)


def word_range(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(n, least, most, below): live documents, the range of their words, and how many are under min_words."""
    w = F.col("word_count")
    return docs.where("present").agg(F.count("*").alias("n"), F.coalesce(F.min(w), F.lit(0)).alias("least"), F.coalesce(F.max(w), F.lit(0)).alias("most"), F.count_if(w < min_words).alias("below"))


def freshness(queue: DataFrame, docs: DataFrame, raw: DataFrame) -> DataFrame:
    """(what, first, last): ranges of the stamps of the queue, the documents and the raw blobs; empty text without any."""
    one = lambda t, c, name: t.agg(F.lit(name).alias("what"), F.coalesce(F.min(c), F.lit("")).alias("first"), F.coalesce(F.max(c), F.lit("")).alias("last"))
    return one(queue, "first_seen_at", "queue_first_seen").unionByName(one(docs, "updated_at", "documents_updated")).unionByName(one(raw, "first_seen_at", "raw_first_seen"))


def raw_by_type(raw: DataFrame) -> DataFrame:
    """(source_type, n, bytes)."""
    return raw.groupBy("source_type").agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def raw_totals(raw: DataFrame) -> DataFrame:
    """(raw, bytes, quality_ok, quality_bad, errored, pending)."""
    return raw.agg(
        F.count("*").alias("raw"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if("quality_ok").alias("quality_ok"), F.count_if(~F.col("quality_ok")).alias("quality_bad"), F.count_if(F.col("extract_error").isNotNull()).alias("errored"),
        F.count_if(F.col("extract_state") == "pending").alias("pending"),
    )


def candidates(queue: DataFrame, raw: DataFrame) -> DataFrame:
    """(candidates): present URLs whose blob passed the gate."""
    return queue.where("present").join(raw.where("quality_ok").select("content_sha256"), "content_sha256").agg(F.count("*").alias("candidates"))


def extract_errors(raw: DataFrame, n: int = 12) -> DataFrame:
    return top(raw.where("extract_error is not null"), F.col("extract_error"), "error", n, 140)


def statuses(log: DataFrame, n: int = 12) -> DataFrame:
    """(status, n), a missing status as 0."""
    return top(log, F.coalesce("status", F.lit(0)), "status", n)


def errors(log: DataFrame, n: int = 10) -> DataFrame:
    return top(log.where("error is not null and error <> ''"), F.col("error"), "error", n, 100)


def by_class(docs: DataFrame, column: str) -> DataFrame:
    """(column, n) of live documents that have one."""
    return docs.where("present").where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def state_counts(queue: DataFrame, docs: DataFrame, raw: DataFrame) -> DataFrame:
    """One row: URLs pending, done, with errors, present and removed; blobs pending; documents live, removed and unclassified."""
    q = queue.agg(*(F.count_if(F.col("work_state") == s).alias(f"queue_{s}") for s in ("pending", "done", "error")), F.count_if("present").alias("urls_present"), F.count_if(~F.col("present")).alias("urls_removed"))
    r = raw.agg(F.count_if(F.col("extract_state") == "pending").alias("raw_pending"))
    d = docs.agg(F.count_if("present").alias("documents"), F.count_if(~F.col("present")).alias("documents_removed"), F.count_if(F.col("present") & F.col("department").isNull()).alias("unclassified"))
    return q.crossJoin(F.broadcast(r)).crossJoin(F.broadcast(d))  # one row each


def findings(sites: DataFrame, documents: int, below: int, min_words: int, links: dict) -> list[dict]:
    """Ranked findings on the report's rows, which are one for each site."""
    rows, out = [r.asDict() for r in sites.collect()], []
    counts = sorted(r["docs"] for r in rows if r["docs"] > 0)
    mid = counts[len(counts) // 2] if counts else 0
    thin = {r["site"] for r in rows if mid and r["docs"] < max(200, 0.15 * mid)}
    for r in rows:
        if r["site"] in thin:
            out.append(("crit" if r["docs"] < 0.05 * mid else "warn", f"{r['site']} is under-covered", f"{r['docs']:,} documents; the median of all sites is {mid:,}; {r['error']:,} queue errors, {r['error_rate']:.0%} of attempts"))
    if below:
        out.append(("warn", f"{below:,} documents below min_words={min_words}", f"{below / max(1, documents):.0%} of the corpus"))
    if documents and links["distinct_src"] < 0.5 * documents:
        out.append(("warn", "Link graph is largely unpopulated", f"{links['total']:,} edges from {links['distinct_src']:,} pages; {links.get('docs_no_out', 0):,} of {documents:,} documents have none"))
    out += [("info", f"{r['site']} has elevated fetch errors", f"{r['error']:,} URLs, {r['error_rate']:.0%} of attempts") for r in rows if r["site"] not in thin and r["error"] >= 100 and r["error_rate"] > 0.1]
    order = {"crit": 0, "warn": 1, "info": 2}
    return [dict(zip(("sev", "title", "detail"), x)) for x in sorted(out, key=lambda x: order[x[0]])] or [{"sev": "ok", "title": "No issues detected", "detail": "Coverage, extraction and links look healthy."}]
