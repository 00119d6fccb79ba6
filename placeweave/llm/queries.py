"""Registered queries of the operators, and SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placeweave.llm import (
    embeddings,
    jaccard,
    langid,
    lexical_search,
    licenses,
    mixing,
    packing,
    pii,
    quality,
    secret_scan,
    substring_dedup,
    token_alignment,
    token_trees,
)
from placeweave.plans.registry import table
from placeweave.session import scratch_path


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In two rounds over one ledger: the second finds every text seen under one
    rule version and scans it for the other."""
    docs, ledger = _documents(spark, sf_dir), scratch_path(spark, "ledger")
    secret_scan.update_ledger(docs, ledger, rules=["base@1"])
    return secret_scan.secret_report(docs, ledger)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_trees.edit_report(_documents(spark, sf_dir))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_documents(spark, sf_dir))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.shingle_components(_documents(spark, sf_dir))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_documents(spark, sf_dir))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_documents(spark, sf_dir))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(_documents(spark, sf_dir))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_documents(spark, sf_dir))


def op10_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_report(_documents(spark, sf_dir))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_report(_documents(spark, sf_dir))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_secret_scans": op2_secret_scans,
    "op3_token_counts": op3_token_counts,
    "op4_pii": op4_pii,
    "op5_ngram_jaccard_join": op5_ngram_jaccard_join,
    "op6_packing": op6_packing,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_source_mixing": op9_source_mixing,
    "op10_license_scans": op10_license_scans,
    "op11_token_alignment": op11_token_alignment,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_lexical_search": op13_lexical_search,
}

ORACLES: dict[str, str] = {
    "op10_license_scans": licenses.oracle_sql(),
    "op12_substring_dedup": substring_dedup.oracle_sql(),
    "op13_lexical_search": lexical_search.oracle_sql(),
}
