"""Mixing sources to target weights by capped water-filling.

A source of size n (characters) with target weight w gets min(E * n, L * w) characters, where E is the
most epochs and L is the water level at which the shares add up to the budget. That is the fixed point
of clamping every source above its cap and redistributing the excess in proportion to the weights of
the rest; sorted by E * n / w the clamped sources are a prefix, so one window pass finds it (the level of the first source that is not clamped, which is the greatest of those that hold). A source's
rate is its share over its size: each document is repeated floor(rate) times, and once more if its
seeded draw is below the fraction.

Defined results: a null or unlisted source has weight 0 and is left out (with weights=None every source,
null too, has weight 1); null and empty texts count 0 characters and are repeated at their source's
rate; a source without characters has rate 0; rows with the same doc_id share one draw, so repeated rows
are repeated alike; null ids share one draw; an empty table gives an empty result. All columns of the
input are kept; `repetition` (0-based) is added and replaces a column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Sources whose rates are broadcast; beyond it Spark joins by shuffle, with its skew handling.
MOST_BROADCAST = 100_000


def unit_draw(seed: int, key: Column) -> Column:
    """Number in [0, 1) from MD5 of seed and key; the same in any engine that has MD5."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def source_rates(docs: DataFrame, weights: dict[str, float] | None, max_epochs: float, budget: int | None = None) -> DataFrame:
    """(wl_source, wl_chars, wl_weight, wl_rate): the water-filled repetition rate of each source."""
    spark = docs.sparkSession
    sizes = docs.select(F.col("source").cast("string").alias("wl_source"), F.coalesce(F.length("text"), F.lit(0)).alias("n")).groupBy("wl_source").agg(F.sum("n").cast("bigint").alias("wl_chars"))
    if weights is None:
        sized = sizes.withColumn("wl_weight", F.lit(1.0))
    else:
        table = spark.createDataFrame([(str(k), float(v)) for k, v in weights.items()], "wl_source string, wl_weight double")
        sized = sizes.join(table, "wl_source", "left").fillna(0.0, ["wl_weight"])
    total = F.sum("wl_chars").over(W.partitionBy()) if budget is None else F.lit(int(budget))
    sized = sized.withColumn("total", total).where("wl_weight > 0 and wl_chars > 0").withColumn("cap", F.col("wl_chars") * F.lit(float(max_epochs)))
    # one row per source: the windows below have one partition, of the size of the source list
    order = W.orderBy(F.col("cap") / F.col("wl_weight"), F.col("wl_source").asc_nulls_first())
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("wl_weight").over(order.rowsBetween(0, W.unboundedFollowing))
    level = (F.col("total") - F.col("before")) / F.col("left")
    return (
        sized.withColumn("before", before).withColumn("left", left)
        .withColumn("level", F.when(level <= F.col("cap") / F.col("wl_weight"), level))
        .withColumn("level", F.max("level").over(W.partitionBy()))
        .withColumn("wl_rate", F.least(F.lit(float(max_epochs)), F.coalesce(F.col("level") * F.col("wl_weight") / F.col("wl_chars"), F.lit(float(max_epochs)))))
        .select("wl_source", "wl_chars", "wl_weight", "wl_rate")
    )


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None, max_epochs: float = 4.0, budget: int | None = None, seed: int = 17) -> DataFrame:
    """docs, each repeated at its source's rate, with `repetition`. budget: characters to sample; that of docs if None."""
    rates = source_rates(docs, weights, max_epochs, budget).select("wl_source", "wl_rate")
    rows = rates.limit(MOST_BROADCAST + 1).collect()
    if len(rows) <= MOST_BROADCAST:
        rates = F.broadcast(docs.sparkSession.createDataFrame(rows, "wl_source string, wl_rate double"))
    d = docs.drop("repetition")
    # names that no column of the input has
    own = "wl_"
    while any(c.lower().startswith(own) for c in d.columns):
        own += "_"
    name, rate, n = f"{own}source", F.col(f"{own}rate"), f"{own}times"
    rates = rates.toDF(name, f"{own}rate")
    joined = d.join(rates, d["source"].cast("string").eqNullSafe(rates[name]))
    times = F.floor(rate) + F.when(unit_draw(seed, F.col("doc_id")) < rate - F.floor(rate), 1).otherwise(0)
    return (
        joined.withColumn(n, times.cast("int")).where(F.col(n) > 0)
        .withColumn("repetition", F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
        .select(*d.columns, "repetition")
    )


def mix_sql(docs: str, weights: dict[str, float], max_epochs: float, seed: int, columns: str) -> str:
    """DuckDB SQL of mix_sources over the table or query `docs`."""
    values = ", ".join(f"('{k}', {float(v)!r}::DOUBLE)" for k, v in weights.items())
    e = f"{float(max_epochs)!r}::DOUBLE"
    return f"""
    WITH d AS (SELECT * FROM {docs}),
    weights(source, weight) AS (VALUES {values}),
    sizes AS (SELECT source, sum(coalesce(length(text), 0))::BIGINT AS chars FROM d GROUP BY source),
    sized AS (SELECT s.source, s.chars, coalesce(w.weight, 0) AS weight, (SELECT sum(chars)::BIGINT FROM sizes) AS total, s.chars * {e} AS cap
              FROM sizes s LEFT JOIN weights w ON w.source = s.source),
    ordered AS (SELECT *, coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                sum(weight) OVER (ORDER BY cap / weight, source NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS remaining
                FROM sized WHERE weight > 0 AND chars > 0),
    level AS (SELECT max((total - before) / remaining) AS level FROM ordered WHERE (total - before) / remaining <= cap / weight),
    rates AS (SELECT source, least({e}, coalesce(level * weight / chars, {e})) AS rate FROM ordered, level),
    times AS (SELECT d.*, (floor(rate) + CASE WHEN ('0x' || substr(md5('{seed}:' || d.doc_id), 1, 8))::BIGINT / 4294967296.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END)::INT AS n
              FROM d JOIN rates r ON r.source = d.source)
    SELECT {columns} FROM (SELECT *, unnest(range(0, n))::INT AS repetition FROM times WHERE n > 0)
    """
