"""Session settings and checked broadcasts shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpointed(df: DataFrame) -> DataFrame:
    """df with its lineage cut, written to the folder that the session names in spark.checkpoint.dir; all executors share it."""
    spark = df.sparkSession
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        # unset in local tests only; a cluster names a shared folder
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; it has to name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="weftline-"))
    elif spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir"))
    return df.checkpoint()


def small(df: DataFrame, most: int) -> list | None:
    """Rows of df if there are no more than `most`, else None."""
    rows = df.limit(most + 1).collect()
    return rows if len(rows) <= most else None


def semi_join(df: DataFrame, keys: DataFrame, on: list[str], most: int = 4_000_000) -> DataFrame:
    """Rows of df whose key is in keys. Up to `most` keys are broadcast after they were counted; more are joined by shuffle."""
    if keys.count() <= most:
        keys = F.broadcast(keys)
    return df.join(keys, on, "left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: list[str], most: int = 4_000_000) -> DataFrame:
    """Rows of df whose key is not in keys; keys are broadcast as in semi_join."""
    if keys.count() <= most:
        keys = F.broadcast(keys)
    return df.join(keys, on, "left_anti")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
