"""Queries over the driver's tables, one for each operator of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import edit_fingerprint, fm_substring, host_rules, html_density, jaccard_join, mil_classifier, mixing, pii, sp_viterbi, suffix_family

#: Production parameters. The key of the pseudonyms is the setting spark.weftline.pii.key; PII_KEY, for tests, is public.
PII_KEY = b"weftline pseudonym key, rotate per release"
MIX_WEIGHTS = {f"src{i}": float(1 + 2 * (i % 4)) for i in range(20)}
MIX_EPOCHS = 2.0
MIX_SEED = 17
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
PASSAGE_WORDS = 50
JACCARD_N, JACCARD_THRESHOLD = 4, 0.5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pii_key(spark: SparkSession) -> bytes:
    """The session's key, of at most 64 bytes, or the public one where none is set."""
    key = spark.conf.get("spark.weftline.pii.key", None)
    return key.encode() if key else PII_KEY


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii_key(spark))


def op2_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract_pages(table(spark, sf_dir, "pages"))


def op3_fm_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_substring.repeated_passages(table(spark, sf_dir, "documents"), PASSAGE_WORDS)


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.host_rules(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_EPOCHS, seed=MIX_SEED)


def op6_suffix_family(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_family.repeated_passages(table(spark, sf_dir, "documents"), PASSAGE_WORDS)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"), JACCARD_N, JACCARD_THRESHOLD)


def op8_mil_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mil_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sp_viterbi.encode_documents(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op10_edit_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprint.edit_links(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_html_density": op2_html_density,
    "op3_fm_substring": op3_fm_substring,
    "op4_host_rules": op4_host_rules,
    "op5_mixing": op5_mixing,
    "op6_suffix_family": op6_suffix_family,
    "op7_jaccard_join": op7_jaccard_join,
    "op8_mil_classifier": op8_mil_classifier,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_edit_fingerprint": op10_edit_fingerprint,
}

ORACLES: dict[str, str] = {
    "op4_host_rules": host_rules.host_rules_sql(),
    "op5_mixing": mixing.mix_sql("documents", MIX_WEIGHTS, MIX_EPOCHS, MIX_SEED, "doc_id, text, lang, source, n_chars, repetition"),
}
