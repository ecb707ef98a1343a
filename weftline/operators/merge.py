"""Document snapshots: upsert with tombstones, canonical URL per text, change feed. Snapshots are immutable; every operator returns the next one.

A snapshot has url, final_url, site, source_type, content_sha256, title, text, lang, text_sha256, present, revision,
first_indexed_at, updated_at. Timestamps are strings in UTC; one per run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls

CONTENT = ("final_url", "site", "source_type", "content_sha256", "title", "text", "lang", "text_sha256")
STATE = ("present", "revision", "first_indexed_at", "updated_at")


def canonical_rank(by: Column, url: Column) -> Column:
    """1 for the cleanest URL of each text."""
    k = urls.canonical_key(url)
    return F.row_number().over(W.partitionBy(by).orderBy(k["n_params"], k["length"], k["url"]))


def dedup_texts(docs: DataFrame, nfc: bool = True) -> DataFrame:
    """docs with text_sha256 and canonical (boolean): one URL of each text is. Null texts count as empty."""
    hashed = docs.withColumn("text_sha256", tx.text_hash(F.col("text"), nfc))
    return hashed.withColumn("canonical", canonical_rank(F.col("text_sha256"), F.col("url")) == 1)


def retire_duplicates(snapshot: DataFrame, now: str, nfc: bool = True) -> DataFrame:
    """Snapshot with hashes filled in and all but the cleanest live URL of each text retired. Running it again changes nothing."""
    s = snapshot.withColumn("text_sha256", F.coalesce("text_sha256", tx.text_hash(F.col("text"), nfc)))
    k = urls.canonical_key(F.col("url"))
    rank = F.row_number().over(W.partitionBy("text_sha256", "present").orderBy(k["n_params"], k["length"], k["url"]))
    lost = F.col("present") & (F.col("rank") > 1)
    return s.withColumn("rank", rank).withColumns({"updated_at": F.when(lost, F.lit(now)).otherwise(F.col("updated_at")), "present": F.col("present") & ~lost}).drop("rank")


def upsert(snapshot: DataFrame, incoming: DataFrame, now: str) -> DataFrame:
    """The next snapshot, with `outcome` (new, changed, unchanged, duplicate, retired, kept).

    incoming: url and CONTENT, a row for each URL. A text keeps its cleanest URL among live and incoming
    rows; a loser without an earlier row makes none, one with an earlier row keeps its old text in a tombstone. A
    changed text counts up the revision; a row that comes back is stamped. Unlike a row-by-row fold, the result
    doesn't depend on the order of the batch.
    """
    old = snapshot.select("url", *(F.col(c).alias(f"o_{c}") for c in (*CONTENT, *STATE)))
    new = incoming.select("url", *(F.col(c).alias(f"n_{c}") for c in CONTENT), F.lit(True).alias("is_in"))
    j = old.join(new, "url", "full_outer").withColumns({"is_in": F.coalesce("is_in", F.lit(False)), "is_old": F.col("o_revision").isNotNull(), "live": F.coalesce("o_present", F.lit(False))})
    sha = F.when(F.col("is_in"), F.col("n_text_sha256")).otherwise(F.col("o_text_sha256"))
    j = j.withColumn("sha", sha).withColumn("takes_part", F.col("is_in") | F.col("live"))
    k = urls.canonical_key(F.col("url"))
    # rows that don't take part stand alone, so that a null or an old hash never forms a hot group
    group = F.when(F.col("takes_part") & F.col("sha").isNotNull(), F.col("sha")).otherwise(F.concat(F.lit("url:"), F.col("url")))
    j = j.withColumn("group", group).withColumn("wins", F.row_number().over(W.partitionBy("group").orderBy(k["n_params"], k["length"], k["url"])) == 1)
    same = F.col("n_text_sha256").eqNullSafe(F.col("o_text_sha256"))
    outcome = (
        F.when(~F.col("takes_part"), "kept")
        .when(~F.col("wins") & ~F.col("is_old"), "dropped")
        .when(~F.col("wins"), F.when(F.col("is_in"), "duplicate").otherwise("retired"))
        .when(~F.col("is_in"), "kept")
        .when(~F.col("is_old"), "new")
        .when(~same, "changed")
        .otherwise("unchanged")
    )
    j = j.withColumn("outcome", outcome).where("outcome <> 'dropped'")
    takes = F.col("outcome").isin("new", "changed", "unchanged")
    back = F.col("is_old") & ~F.col("live") & (F.col("outcome") == "unchanged")
    gone = F.col("outcome").isin("duplicate", "retired")
    stamped = F.col("outcome").isin("new", "changed") | back | (gone & F.col("live"))
    return j.select(
        "url",
        *(F.when(takes, F.col(f"n_{c}")).otherwise(F.col(f"o_{c}")).alias(c) for c in CONTENT),
        F.when(takes, True).when(gone, False).otherwise(F.col("live")).alias("present"),
        F.when(F.col("outcome") == "new", 1).when(F.col("outcome") == "changed", F.col("o_revision") + 1).otherwise(F.col("o_revision")).cast("int").alias("revision"),
        F.coalesce("o_first_indexed_at", F.lit(now)).alias("first_indexed_at"),
        F.when(stamped, F.lit(now)).otherwise(F.col("o_updated_at")).alias("updated_at"),
        "outcome",
    )


def remove(snapshot: DataFrame, gone: DataFrame, now: str) -> DataFrame:
    """Live rows whose url is in gone become tombstones, stamped once."""
    j = snapshot.join(gone.select("url").distinct().withColumn("hit", F.lit(True)), "url", "left")
    hit = F.col("present") & F.coalesce("hit", F.lit(False))
    return j.withColumns({"updated_at": F.when(hit, F.lit(now)).otherwise(F.col("updated_at")), "present": F.col("present") & ~hit}).drop("hit")


def delta(snapshot: DataFrame, since: str) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletions) stamped later than since."""
    late = snapshot.where(F.col("updated_at") > since)
    return late.where("present"), late.where("not present").select("url", "updated_at")


def detect_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(url, outcome) of two tables of (url, content_sha256): new, changed, unchanged or removed."""
    o, n = old.select("url", F.col("content_sha256").alias("o"), F.lit(True).alias("was")), new.select("url", F.col("content_sha256").alias("n"), F.lit(True).alias("is"))
    outcome = F.when(F.col("was").isNull(), "new").when(F.col("is").isNull(), "removed").when(F.col("o").eqNullSafe(F.col("n")), "unchanged").otherwise("changed")
    return o.join(n, "url", "full_outer").select("url", outcome.alias("outcome"))


def backfill(snapshot: DataFrame, log: DataFrame, language) -> DataFrame:
    """Live rows get a missing language, the final_url of their last stored fetch of the same bytes, and a missing title from the URL; stamps stay."""
    last = log.where("outcome in ('new', 'changed', 'unchanged') and sha256 is not null and final_url is not null").groupBy("url", F.col("sha256").alias("content_sha256")).agg(F.max_by("final_url", "id").alias("last_url"))
    j = snapshot.join(last, ["url", "content_sha256"], "left")
    fill = lambda c, v: F.when(F.col("present"), F.coalesce(F.col(c), v)).otherwise(F.col(c))
    return j.withColumns(
        {"lang": fill("lang", language(F.col("text"))), "title": fill("title", urls.title_from_url(F.col("url"))), "final_url": F.when(F.col("present"), F.coalesce("last_url", "final_url")).otherwise(F.col("final_url"))}
    ).select(*snapshot.columns)


#: Hexadecimal digits that new values are told apart by before they are numbered.
BUCKET_DIGITS = 64


def intern(known: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """known (id, name) and the new values of name, numbered on in order of their bytes. One task sees a row for each bucket of BUCKET_DIGITS / 2 first bytes, none sees all values."""
    fresh = values.select(name).where(F.col(name).isNotNull()).distinct().join(known, name, "left_anti")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("top"))
    # values are ordered within buckets of their first characters; a bucket's numbers begin behind those of the buckets before it
    bucket = fresh.withColumn("bucket", F.substring(F.hex(F.encode(name, "utf-8")), 1, BUCKET_DIGITS))
    sizes = bucket.groupBy("bucket").agg(F.count("*").alias("size"))
    begins = sizes.withColumn("begin", F.sum("size").over(W.orderBy("bucket").rowsBetween(W.unboundedPreceding, -1))).select("bucket", F.coalesce("begin", F.lit(0)).alias("begin"))
    numbered = bucket.join(begins, "bucket").crossJoin(F.broadcast(top)).select((F.col("top") + F.col("begin") + F.row_number().over(W.partitionBy("bucket").orderBy(name))).cast("bigint").alias("id"), name)
    return known.select(F.col("id").cast("bigint").alias("id"), name).unionByName(numbered)
