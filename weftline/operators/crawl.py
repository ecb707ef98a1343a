"""Crawl state: outcomes of fetches, frontier, budgets and the wave loop. The fetcher is a Python callable or a table."""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import links, urls


def is_transient(status: Column) -> Column:
    return status.isin(0, 408, 429) | status.between(500, 599)


def outcomes(fetched: DataFrame, frontier: DataFrame, domain: Column | None = None) -> DataFrame:
    """Fetch results (url, final_url, status, content_type, data, etag, last_modified, error) against what the frontier (url, content_sha256, present, etag, last_modified) knows.

    Adds kind, sha256, known_sha256, outcome (unchanged, removed, error, skipped, new, changed), and the validators to keep:
    those of an unchanged page stay unless it sends others, those of a removed one go. Branches in order: not
    modified, empty success (unchanged if there was content, else skipped), 404 or 410, other failures, redirect off
    the domain, other kinds of content, stored. A page that was removed and comes back with the same bytes is changed.
    """
    known = frontier.select("url", F.col("content_sha256").alias("known_sha256"), F.col("present").alias("was_present"), F.col("etag").alias("known_etag"), F.col("last_modified").alias("known_modified"))
    j = fetched.join(known, "url", "left")
    d = urls.host(F.col("url")) if domain is None else domain
    at, success = F.coalesce("final_url", "url"), F.col("error").isNull() & F.col("status").between(200, 299)
    j = j.withColumns({"kind": urls.route_kind(F.col("content_type"), at), "sha256": F.when(F.length("data") > 0, F.sha2("data", 256))})
    outcome = (
        F.when(F.col("status") == 304, "unchanged")
        .when(success & F.col("sha256").isNull(), F.when(F.col("known_sha256").isNotNull(), "unchanged").otherwise("skipped"))
        .when(F.col("status").isin(404, 410), "removed")
        .when(~success, "error")
        .when(~urls.in_domain(at, d), "skipped")
        .when(F.col("kind") == "other", "skipped")
        .when(F.col("known_sha256").isNull(), "new")
        .when((F.col("known_sha256") == F.col("sha256")) & F.coalesce("was_present", F.lit(True)), "unchanged")
        .otherwise("changed")
    )
    j = j.withColumn("outcome", F.coalesce(outcome, F.lit("error")))
    keeps = F.col("outcome") != "removed"
    return j.withColumns({"keep_etag": F.when(keeps, F.coalesce("etag", "known_etag")), "keep_modified": F.when(keeps, F.coalesce("last_modified", "known_modified"))})


def enqueue(queue: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of found (url, site, discovered_from, depth) that the queue doesn't have, one for each URL, least depth first, as pending."""
    order = W.partitionBy("url").orderBy(F.col("depth").asc_nulls_last(), F.col("discovered_from").asc_nulls_first())
    one = found.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")
    return one.join(queue.select("url"), "url", "left_anti").withColumn("work_state", F.lit("pending"))


def merge_sitemap(queue: DataFrame, sitemap: DataFrame) -> DataFrame:
    """Queue with the sitemap's lastmod: a later string requeues, a first one is only stored; unknown URLs come in as pending."""
    s = sitemap.select("url", F.col("lastmod").alias("s"), F.lit(True).alias("listed")).dropDuplicates(["url"])
    j = queue.join(s, "url", "full_outer")
    later = F.col("s") > F.col("sitemap_lastmod")
    return j.withColumns(
        {"work_state": F.when(F.col("work_state").isNull() | F.coalesce(later, F.lit(False)), "pending").otherwise(F.col("work_state")), "sitemap_lastmod": F.when(F.coalesce(later, F.lit(False)), F.col("s")).otherwise(F.coalesce("sitemap_lastmod", "s"))}
    ).drop("s", "listed")


def requeue(queue: DataFrame, mode: str = "all", retry_transient: bool = True) -> DataFrame:
    """Start of a run. all and force-full: done rows that are present are pending again; else only rows that failed for a passing cause, if asked for; interrupted rows always."""
    again = F.col("work_state") == "in_progress"
    if retry_transient:
        again = again | ((F.col("work_state") == "error") & is_transient(F.coalesce("http_status", F.lit(0))))
    if mode in ("all", "force-full"):
        again = again | ((F.col("work_state") == "done") & F.coalesce("present", F.lit(True)))
    q = queue.withColumn("work_state", F.when(again, "pending").otherwise(F.col("work_state")))
    return q.withColumns({"etag": F.lit(None).cast("string"), "last_modified": F.lit(None).cast("string")}) if mode == "force-full" else q


def frontier(queue: DataFrame, only_new: bool = False) -> DataFrame:
    """Pending URLs that are no traps, in breadth-first order."""
    q = queue.where("work_state = 'pending'").where(~urls.is_trap(F.col("url")))
    return (q.where("last_checked_at is null") if only_new else q).orderBy("depth", "url")


def admit(candidates: DataFrame, per_site: int | None = None, per_host: int | None = None, used: DataFrame | None = None) -> DataFrame:
    """The least (depth, url) first, up to the hosts' budgets and then the sites'. used: (site, host, n) admitted before. The rest is dropped for this run."""
    c = candidates.withColumn("host", urls.host(F.col("url")))
    before = lambda key: used.groupBy(*key).agg(F.sum("n").alias("spent"))
    for key, most in ((("site", "host"), per_host), (("site",), per_site)):
        if most is None:
            continue
        c = c.join(before(key), list(key), "left") if used is not None else c.withColumn("spent", F.lit(0))
        order = W.partitionBy(*key).orderBy("depth", "url")
        c = c.withColumn("k", F.row_number().over(order) + F.coalesce("spent", F.lit(0))).where(F.col("k") <= most).drop("k", "spent")
    return c


QUEUE = "url string, site string, discovered_from string, work_state string, etag string, last_modified string, sitemap_lastmod string, content_sha256 string, first_seen_at string, last_checked_at string, last_changed_at string, depth bigint, http_status int, present boolean"


def mark(queue: DataFrame, got: DataFrame, now: str) -> DataFrame:
    """Queue after the outcomes got (url, status, outcome, sha256, etag, last_modified).

    new and changed pages are done, present, with their digest and validators; unchanged and skipped ones are done and present, keep their
    digest, and keep validators that are not sent again; removed ones are done, absent and without validators; errors keep all but the state and status. Off-domain and other bodies count as status 200.
    """
    g = got.select("url", F.col("status").alias("g_status"), F.col("outcome").alias("g_outcome"), F.col("sha256").alias("g_sha"), F.col("etag").alias("g_etag"), F.col("last_modified").alias("g_modified"))
    j = queue.join(g, "url", "left")
    o, hit = F.col("g_outcome"), F.col("g_outcome").isNotNull()
    stored, removed, error = o.isin("new", "changed"), o == "removed", o == "error"
    status = F.when(stored | (o.isin("skipped", "unchanged") & F.col("g_sha").isNotNull()), 200).otherwise(F.col("g_status"))
    keep = lambda c, new: F.when(stored, F.col(new)).when(removed, None).when(hit & ~error, F.coalesce(new, c)).otherwise(F.col(c))
    return j.withColumns(
        {
            "work_state": F.when(error, "error").when(hit, "done").otherwise(F.col("work_state")),
            "http_status": F.when(hit, status).otherwise(F.col("http_status")).cast("int"),
            "etag": keep("etag", "g_etag"),
            "last_modified": keep("last_modified", "g_modified"),
            "content_sha256": F.when(stored, F.col("g_sha")).otherwise(F.col("content_sha256")),
            "present": F.when(removed, False).when(hit & ~error, True).otherwise(F.col("present")),
            "last_checked_at": F.when(hit, now).otherwise(F.col("last_checked_at")),
            "last_changed_at": F.when(stored | removed, now).otherwise(F.col("last_changed_at")),
        }
    ).select(*queue.columns)


def insert_edges(known: DataFrame, edges: DataFrame) -> DataFrame:
    """known and the edges (src, dst, site, in_domain, depth, first_seen_at) that it doesn't have; of several the one of least depth, and an edge that is known keeps its depth."""
    order = W.partitionBy("src", "dst").orderBy("depth", "first_seen_at")
    one = edges.withColumn("k", F.row_number().over(order)).where("k = 1").drop("k")
    return known.unionByName(one.join(known.select("src", "dst"), ["src", "dst"], "left_anti").select(*known.columns))


def insert_blobs(raw: DataFrame, blobs: DataFrame, now: str) -> DataFrame:
    """Raw table after blobs (content_sha256, source_type, bytes, data): unknown ones come in as pending, known ones are pending again."""
    held = raw.join(blobs.select("content_sha256", F.lit(True).alias("again")).dropDuplicates(["content_sha256"]), "content_sha256", "left")
    held = held.withColumn("extract_state", F.when(F.col("again"), "pending").otherwise(F.col("extract_state"))).select(*raw.columns)
    fresh = blobs.dropDuplicates(["content_sha256"]).join(raw.select("content_sha256"), "content_sha256", "left_anti").withColumns({"extract_state": F.lit("pending"), "first_seen_at": F.lit(now)})
    return held.unionByName(fresh, allowMissingColumns=True)


def requeue_url(queue: DataFrame, url: str) -> DataFrame:
    return queue.withColumn("work_state", F.when(F.col("url") == url, "pending").otherwise(F.col("work_state")))


def url_state(queue: DataFrame, url: str) -> DataFrame:
    """The row of one URL."""
    return queue.where(F.col("url") == url)


def reset_site(tables: dict[str, DataFrame], site: str) -> dict[str, DataFrame]:
    """Queue, log, documents and links without the site's rows; raw blobs stay."""
    return {k: t.where(~F.col("site").eqNullSafe(F.lit(site))) if k in ("queue", "crawl_log", "documents", "links") else t for k, t in tables.items()}


def count_pending(queue: DataFrame, site: str | None = None, only_new: bool = False) -> DataFrame:
    """(pending): URLs that wait, of one site or all; with only_new those never checked."""
    on = F.col("work_state") == "pending"
    if site is not None:
        on = on & (F.col("site") == site)
    return queue.agg(F.count_if(on & F.col("last_checked_at").isNull() if only_new else on).alias("pending"))


def outcome_counts(log: DataFrame) -> DataFrame:
    """(site, new, changed, unchanged, removed, error, skipped) of a run's log."""
    return log.groupBy("site").agg(*(F.count_if(F.col("outcome") == o).alias(o) for o in ("new", "changed", "unchanged", "removed", "error", "skipped")))


def edges_of(got: DataFrame, blobs: DataFrame | None = None) -> DataFrame:
    """(src, dst, site, in_domain, trap, depth) of fetched pages (url, final_url, site, depth, data, kind, status, outcome): links resolve against the final URL. Those of a page that was
    not modified come from its cached blob (content_sha256, data), against its own URL."""
    fresh = got.where("outcome in ('new', 'changed', 'unchanged') and kind = 'html' and length(data) > 0 and status <> 304").select("url", F.coalesce("final_url", "url").alias("base"), "site", "depth", F.col("data").cast("string").alias("html"))
    if blobs is not None:
        held = blobs.where("source_type = 'html'").select(F.col("content_sha256").alias("known_sha256"), F.col("data").cast("string").alias("html"))
        fresh = fresh.unionByName(got.where("status = 304").select("url", F.col("url").alias("base"), "site", "depth", "known_sha256").join(held, "known_sha256").select("url", "base", "site", "depth", "html"))
    e = fresh.select(F.col("url").alias("src"), "site", (F.col("depth") + 1).alias("depth"), F.explode(links.discover_links(F.col("html"), F.col("base"))).alias("dst"))
    return e.select("src", "dst", "site", urls.in_domain(F.col("dst"), F.col("site")).alias("in_domain"), urls.is_trap(F.col("dst")).alias("trap"), "depth")


def run(
    queue: DataFrame, seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], save: Callable[[str, int, DataFrame], DataFrame], now: str, mode: str = "all", retry_transient: bool = True, sitemap: DataFrame | None = None, blobs: DataFrame | None = None, per_site: int | None = None,
    per_host: int | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One incremental crawl over the known state: (queue, fetch results with outcomes, edges) after it.

    Sitemap entries (url, site, lastmod) and seeds (url, site; site is the allowed domain) join the queue, mode decides what is checked again, and waves go on until one is empty. fetch
    gets (url, site, depth, etag, last_modified) of a wave, without validators under force-full. A wave's links are new only if no queue row has them.
    """
    if sitemap is not None:
        listed = merge_sitemap(queue, sitemap)
        own = sitemap.select("url", F.col("site").alias("s_site")).dropDuplicates(["url"])
        listed = listed.join(own, "url", "left").withColumns({"site": F.coalesce("site", "s_site"), "first_seen_at": F.coalesce("first_seen_at", F.lit(now)), "depth": F.coalesce("depth", F.lit(0).cast("bigint")), "present": F.coalesce("present", F.lit(True))})
        queue = listed.select(*queue.columns)
    start = enqueue(queue, seeds.select("url", "site", F.lit(None).cast("string").alias("discovered_from"), F.lit(0).cast("bigint").alias("depth")))
    fresh = lambda found: found.withColumns({"first_seen_at": F.lit(now), "present": F.lit(True)})
    queue = requeue(queue.unionByName(fresh(start), allowMissingColumns=True), mode, retry_transient and mode != "new-only")
    queue = save("queue", 0, queue)
    todo = frontier(queue, mode == "new-only").select("url")
    done = edges = used = None
    for k in count():
        wave = queue.join(todo, "url", "left_semi").where(~urls.is_trap(F.col("url")))
        chosen = save("chosen", k, admit(wave, per_site, per_host, used))
        if chosen.isEmpty():
            break
        answers = fetch(chosen.select("url", "site", "depth", "etag", "last_modified"))
        answers = answers.select("url", "final_url", "status", "content_type", "data", "etag", "last_modified", "error").join(chosen.select("url", "site", "depth"), "url")
        got = save("fetched", k, outcomes(answers, chosen, F.col("site")))
        found = save("edges", k, edges_of(got, blobs))
        done, edges = (got, found) if done is None else (done.unionByName(got), edges.unionByName(found))
        n = chosen.groupBy("site", "host").agg(F.count("*").alias("n"))
        used = save("used", k, n if used is None else used.unionByName(n).groupBy("site", "host").agg(F.sum("n").alias("n")))
        follow = links.followable(found).join(got.where("status = 304").select(F.col("url").alias("src")), "src", "left_anti")
        new = enqueue(queue, follow.select(F.col("dst").alias("url"), "site", F.col("src").alias("discovered_from"), "depth"))
        new = save("new", k, fresh(new))
        todo = new.select("url")
        queue = save("queue", k + 1, mark(queue, got, now).unionByName(new, allowMissingColumns=True))
    return queue, done, edges


def crawl(seeds: DataFrame, fetch: Callable[[DataFrame], DataFrame], save: Callable[[str, int, DataFrame], DataFrame], per_site: int | None = None, per_host: int | None = None, most_waves: int | None = None) -> DataFrame:
    """Breadth-first waves until a wave is empty; returns every URL that was reached, with its outcome.

    fetch turns (url, site, depth) into fetch results; save(name, wave, df) writes a table and reads it
    again, so every wave starts from stored rows and no lineage grows. If URLs are left after most_waves, it raises.
    """
    wave = save("wave", 0, seeds.select("url", "site", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("discovered_from")).dropDuplicates(["url"]))
    seen, done, used = wave.select("url"), None, None
    empty = "url string, content_sha256 string, present boolean, etag string, last_modified string"
    for k in count():
        chosen = save("chosen", k, admit(wave.where(~urls.is_trap(F.col("url"))), per_site, per_host, used))
        if chosen.isEmpty():
            break
        if k == most_waves:
            raise RuntimeError(f"URLs are left after {k} waves")
        got = save("fetched", k, outcomes(fetch(chosen), seeds.sparkSession.createDataFrame([], empty)).join(chosen.select("url", "site", "depth", "discovered_from"), "url"))
        done = got if done is None else done.unionByName(got)
        n = chosen.groupBy("site", "host").agg(F.count("*").alias("n"))
        used = save("used", k, n if used is None else used.unionByName(n).groupBy("site", "host").agg(F.sum("n").alias("n")))
        pages = got.where("outcome in ('new', 'changed', 'unchanged') and kind = 'html'").select(F.col("data").cast("string").alias("html"), F.coalesce("final_url", "url").alias("url"), "site", "depth")
        edges = links.link_edges(pages).join(pages.select(F.col("url").alias("src"), "site", "depth"), "src")
        found = links.followable(edges).select(F.col("dst").alias("url"), "site", (F.col("depth") + 1).alias("depth"), F.col("src").alias("discovered_from"))
        wave = save("wave", k + 1, enqueue(seen, found).select("url", "site", "depth", "discovered_from"))
        seen = save("seen", k + 1, seen.unionByName(wave.select("url")))
    return done
