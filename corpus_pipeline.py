"""The text pipeline: documents to training windows, stage by stage.

Each stage is (name, function) with function(spark, docs, sf_dir) -> DataFrame.
Stages keep the columns of documents, but for the last, which returns pieces of
windows. A stage's result is written to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from placeweave.llm import jaccard, mixing, packing, quality, secret_scan
from placeweave.session import discard, settle


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers."""
    return quality.keep_good(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return jaccard.keep_one_each(docs, jaccard.Rule(words=5, percent=80))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secret_scan.redact(docs)


def mixed_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of full training windows."""
    return packing.pack(docs)


STAGES = [
    ("quality", good_documents),
    ("near duplicates", one_of_each_group),
    ("secrets", without_secrets),
    ("mixing", mixed_to_weights),
    ("packing", packed),
]

# Outlier estimates, components and packing aren't expressible; tests compare
# the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = settle(docs, name.replace(" ", "-"))
            if before is not None:
                discard(before)
            before = docs
    return docs
