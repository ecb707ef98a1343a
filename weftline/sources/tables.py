"""Tables of a corpus folder: versions of Parquet snapshots, of which one is current.

A write makes a new version beside the old ones and then moves the pointer to it with a rename, so a reader sees the old
version or the new one, never a part, and a job that is lost on the way leaves the table as it was. Old versions go with vacuum.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.crawl import QUEUE

SCHEMAS = {
    "queue": QUEUE,
    "crawl_log": "id bigint, run_id string, url string, final_url string, site string, status int, content_type string, sha256 string, bytes bigint, kind string, outcome string, error string, fetched_at string",
    "raw_docs": "content_sha256 string, source_type string, bytes bigint, data binary, first_seen_at string, extract_state string, title string, text string, markdown string, lang string, metadata map<string,string>, word_count int, quality_ok boolean, reject_reason string, extract_error string, extracted_at string",
    "documents": "url string, final_url string, site string, source_type string, content_sha256 string, title string, text string, lang string, text_sha256 string, present boolean, revision int, first_indexed_at string, updated_at string, campus string, department string, program string, department_source string, version string",
    "links": "src string, dst string, site string, in_domain boolean, depth bigint, first_seen_at string",
}


class Store:
    """Tables under a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p, jvm

    def _current(self, name: str) -> str | None:
        fs, p, jvm = self._fs(f"{self.folder}/{name}/current.json")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()))["version"]
        finally:
            stream.close()

    def read(self, name: str) -> DataFrame:
        """The current version; columns that it doesn't have yet are null, and a table that was never written is empty."""
        empty = self.spark.createDataFrame([], SCHEMAS[name])
        version = self._current(name)
        if version is None:
            return empty
        got = self.spark.read.parquet(f"{self.folder}/{name}/{version}")
        more = [F.lit(None).cast(f.dataType).alias(f.name) for f in empty.schema.fields if f.name not in got.columns]
        return got.select("*", *more)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """df as the current version, read again. df may come from the version before."""
        version = uuid.uuid4().hex
        df.write.parquet(f"{self.folder}/{name}/{version}")
        fs, p, jvm = self._fs(f"{self.folder}/{name}/current.json")
        _, new, _ = self._fs(f"{self.folder}/{name}/current.{version}.json")
        stream = fs.create(new, True)
        try:
            stream.write(json.dumps({"version": version}).encode())
        finally:
            stream.close()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        context.rename(new, p, options)
        return self.read(name)

    def vacuum(self, name: str) -> int:
        """Removes all versions but the current one; gives their number. No reader of an old version may be at work."""
        keep = self._current(name)
        fs, p, _ = self._fs(f"{self.folder}/{name}")
        n = 0
        for s in fs.listStatus(p) if fs.exists(p) else []:
            if s.isDirectory() and s.getPath().getName() != keep:
                fs.delete(s.getPath(), True)
                n += 1
        return n

    def saver(self, run: str):
        """save(name, wave, df) for the loops of crawl and sitemaps: writes below the folder and reads again."""

        def save(name: str, k: int, df: DataFrame) -> DataFrame:
            at = f"{self.folder}/_runs/{run}/{name}-{k}"
            df.write.mode("overwrite").parquet(at)
            return self.spark.read.parquet(at)

        return save
