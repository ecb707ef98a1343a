"""Corpus pipeline: quality classifier, near-duplicate join, pseudonyms, source mixing, tokenizing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents; the last returns the ids of
every document that is left. run() writes the stages' results below the folder in spark.checkpoint.dir.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from weftline.llm import jaccard_join, mil_classifier, mixing, pii, queries, sp_viterbi


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier rejects, as low in quality or toxic, go."""
    return mil_classifier.accepted(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return jaccard_join.deduplicated(docs, queries.JACCARD_N, queries.JACCARD_THRESHOLD).select(*docs.columns)


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private values get format-preserving pseudonyms."""
    return pii.pseudonymise(docs, queries.pii_key(spark)).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled and repeated so that sources have their target weights."""
    return mixing.mix_sources(docs, queries.MIX_WEIGHTS, queries.MIX_EPOCHS, seed=queries.MIX_SEED).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, exact) of every document that is left."""
    return sp_viterbi.encode_documents(docs, queries.PIECE_MODEL)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("pseudonyms", private_data),
    ("source mixing", mixture),
    ("SentencePiece", tokens),
]

#: SQL can express neither the trained classifier nor the tokenizer; tests hold run() against its stages, and each operator against brute force, a round trip or held-out accuracy.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result of all stages over the documents of sf_dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set; it has to name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-pipeline-")
    folder = f"{folder}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
