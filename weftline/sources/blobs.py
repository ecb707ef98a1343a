"""Content-addressed blobs: a Parquet table keyed by digest, or files read by binaryFile."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def new_blobs(fetched: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(content_sha256, source_type, bytes, data) of stored bodies that known doesn't have, each once."""
    b = fetched.where("data is not null and length(data) > 0").select(F.sha2("data", 256).alias("content_sha256"), F.col("kind").alias("source_type"), F.length("data").cast("bigint").alias("bytes"), "data").dropDuplicates(["content_sha256"])
    return b if known is None else b.join(known.select("content_sha256"), "content_sha256", "left_anti")


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """(content_sha256, source_type, data) of files named <digest>.<kind>."""
    f = spark.read.format("binaryFile").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return f.select(F.regexp_extract(name, r"^([0-9a-f]{64})\.", 1).alias("content_sha256"), F.regexp_extract(name, r"\.(\w+)$", 1).alias("source_type"), F.col("content").alias("data")).where("content_sha256 <> ''")
