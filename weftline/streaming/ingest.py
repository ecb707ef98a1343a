"""Crawl ingest as a stream: each micro-batch of fetch results becomes one set of appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.links import link_edges


def write_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Appends log rows and edges of one batch, under the batch's number: a repeated batch overwrites itself."""
    batch.select("url", F.sha2("html", 256).alias("sha256"), F.length("html").cast("bigint").alias("bytes")).write.mode("overwrite").parquet(f"{out}/crawl_log/batch={batch_id}")
    link_edges(batch).write.mode("overwrite").parquet(f"{out}/links/batch={batch_id}")


def ingest(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Starts the ingest of a stream of (url, html) over what is there now."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, k: write_batch(df, k, out)).start()
