"""The queries of the operators, each over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.llm import (
    fm,
    iblt,
    jaccard,
    lines,
    merkle,
    mix,
    ngrams,
    packing,
    pieces,
    pii,
    prefixes,
    rules,
    secrets,
)
from terrace.session import ship_package

PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_model() -> str:
    return vocabulary(PIECES)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return iblt.fingerprint_edits(table(spark, sf_dir, "documents"))


def op3_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_documents(table(spark, sf_dir, "documents"))


def op4_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digests(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.digest(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_digests(table(spark, sf_dir, "documents"), piece_model())


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(WORDS))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_fingerprints": op2_fingerprints,
    "op3_lm_scores": op3_lm_scores,
    "op4_secret_scans": op4_secret_scans,
    "op5_line_dedup": op5_line_dedup,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_mixing": op8_mixing,
    "op9_quality_rules": op9_quality_rules,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_packing": op11_packing,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES: dict[str, str] = {
    "op5_line_dedup": lines.ORACLE,
    "op6_ngram_jaccard": jaccard.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_prefix_trie": prefixes.ORACLE,
}
