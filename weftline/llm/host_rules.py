"""Host-level rules: per-document rule failures, aggregated by domain and shrunk with an empirical beta prior.

A domain with f failing of n documents has the posterior mean (f + a) / (n + a + b). The prior Beta(a, b)
is fitted to all domains by moments: the pooled rate m and the n-weighted variance v of the domains'
rates give a + b = m (1 - m) / v - 1, kept within [1, 1e6]. A domain whose shrunk rate is above `drop_above`
is dropped with all its documents; elsewhere a document is kept when it fails no rule itself.

Defined results: null and empty texts fail rule `empty` only; a null domain is a domain of its own; rows
that repeat count each; one domain, or equal rates everywhere, has the strongest prior (1e6); an empty
table gives an empty result. Only the id, the domain and the text are read, so further columns, whatever
their names, have no effect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._spark import checkpointed

SYMBOLS = "*#%$&|!{}<>\\^~="
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RULES = ("empty", "repeated_words", "symbols", "capitals", "repeated_lines")
MOST_BROADCAST = 100_000


def _fails(text: Column) -> dict[str, Column]:
    words = F.filter(F.split(text, "[ \t\r\n]+"), lambda x: x != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    n, n_lines = F.size(words), F.size(lines)
    return {
        "empty": n == 0,
        # distinct words under a fifth of the words
        "repeated_words": (n >= 20) & (F.size(F.array_distinct(words)) * 5 < n),
        # over one symbol for four words
        "symbols": (n >= 5) & ((F.length(text) - F.length(F.translate(text, SYMBOLS, ""))) * 4 > n),
        # over half of the characters are ASCII capitals
        "capitals": (n >= 5) & ((F.length(text) - F.length(F.translate(text, UPPER, ""))) * 2 > F.length(text)),
        # over half of the lines repeat another
        "repeated_lines": (n_lines >= 4) & (F.size(F.array_distinct(lines)) * 2 < n_lines),
    }


def rule_failures(docs: DataFrame, domain: Column) -> DataFrame:
    """(doc_id, domain, n_failed, failed): the rules that each document fails, in RULES order."""
    rules = _fails(F.coalesce(F.col("text"), F.lit("")))
    rows = docs.select(F.col("doc_id"), domain.cast("string").alias("domain"), F.array_compact(F.array(*(F.when(rules[r], F.lit(r)) for r in RULES))).alias("hits"))
    return rows.select("doc_id", "domain", F.size("hits").alias("n_failed"), F.concat_ws(",", "hits").alias("failed"))


def host_rates(failures: DataFrame) -> DataFrame:
    """(domain, host_docs, host_failing, host_rate): shrunk failure rate of each domain."""
    hosts = failures.groupBy("domain").agg(F.count("*").alias("host_docs"), F.count(F.when(F.col("n_failed") > 0, 1)).alias("host_failing"))
    pooled = hosts.agg(F.sum("host_docs").alias("n"), F.sum("host_failing").alias("f"))
    rate = F.col("host_failing") / F.col("host_docs")
    m = F.col("f") / F.col("n")
    prior = hosts.crossJoin(F.broadcast(pooled)).groupBy("n", "f").agg((F.sum(F.col("host_docs") * (rate - m) * (rate - m)) / F.first("n")).alias("v"))
    strength = F.when(F.col("v") > 0, F.least(F.lit(1e6), F.greatest(F.lit(1.0), m * (1 - m) / F.col("v") - 1))).otherwise(F.lit(1e6))
    prior = prior.select(m.alias("m"), strength.alias("s"))
    shrunk = (F.col("host_failing") + F.col("m") * F.col("s")) / (F.col("host_docs") + F.col("s"))
    return hosts.crossJoin(F.broadcast(prior)).select("domain", "host_docs", "host_failing", shrunk.alias("host_rate"))


def host_rules(docs: DataFrame, domain: Column | None = None, drop_above: float = 0.5) -> DataFrame:
    """(doc_id, domain, n_failed, failed, host_docs, host_failing, host_rate, keep) of every document. domain: `source` if None."""
    # the rules run once; what is kept of a document is some twenty bytes
    failures = checkpointed(rule_failures(docs, F.col("source") if domain is None else domain))
    hosts = host_rates(failures)
    if hosts.count() <= MOST_BROADCAST:
        hosts = F.broadcast(hosts)
    h = hosts.withColumnRenamed("domain", "wl_domain")
    return failures.join(h, failures["domain"].eqNullSafe(h["wl_domain"])).select(
        "doc_id", "domain", "n_failed", "failed", "host_docs", "host_failing", F.round("host_rate", 6).alias("host_rate"), ((F.col("host_rate") <= drop_above) & (F.col("n_failed") == 0)).alias("keep")
    )


def host_rules_sql(drop_above: float = 0.5) -> str:
    sym = "".join("\\" + c for c in SYMBOLS)
    return f"""
    WITH t AS (SELECT doc_id, source AS domain, coalesce(text, '') AS text FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(text, '[ \\t\\r\\n]+'), lambda x: x <> '') AS words, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS lines FROM t),
    r AS (SELECT doc_id, domain, list_filter([
            CASE WHEN len(words) = 0 THEN 'empty' END,
            CASE WHEN len(words) >= 20 AND len(list_distinct(words)) * 5 < len(words) THEN 'repeated_words' END,
            CASE WHEN len(words) >= 5 AND (length(text) - length(regexp_replace(text, '[{sym}]', '', 'g'))) * 4 > len(words) THEN 'symbols' END,
            CASE WHEN len(words) >= 5 AND (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) * 2 > length(text) THEN 'capitals' END,
            CASE WHEN len(lines) >= 4 AND len(list_distinct(lines)) * 2 < len(lines) THEN 'repeated_lines' END], lambda x: x IS NOT NULL) AS hits FROM w),
    f AS (SELECT doc_id, domain, len(hits)::INT AS n_failed, coalesce(array_to_string(hits, ','), '') AS failed FROM r),
    h AS (SELECT domain, count(*) AS host_docs, count(*) FILTER (n_failed > 0) AS host_failing FROM f GROUP BY domain),
    p AS (SELECT sum(host_failing)::DOUBLE / sum(host_docs) AS m, sum(host_docs) AS n FROM h),
    v AS (SELECT any_value(m) AS m, sum(host_docs * (host_failing::DOUBLE / host_docs - m) * (host_failing::DOUBLE / host_docs - m)) / any_value(n) AS v FROM h, p),
    s AS (SELECT m, CASE WHEN v > 0 THEN least(1e6::DOUBLE, greatest(1.0::DOUBLE, m * (1 - m) / v - 1)) ELSE 1e6::DOUBLE END AS s FROM v),
    q AS (SELECT h.*, (host_failing + m * s) / (host_docs + s) AS rate FROM h, s)
    SELECT f.doc_id, f.domain, n_failed, failed, host_docs, host_failing, round(rate, 6) AS host_rate, rate <= {drop_above} AND n_failed = 0 AS keep
    FROM f JOIN q ON f.domain IS NOT DISTINCT FROM q.domain
    """
