"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlane.llm import decontamination, packing, quality, simhash_wide, substring
from marketlane.llm.common import table, written


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rejected documents go."""
    return quality.keep_good(docs, table(spark, folder, "labels"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8 and more."""
    return simhash_wide.keep_first(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Repeated lines and sentences are cut out of the texts; every document stays."""
    return substring.dedup_documents(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that copy a test item go."""
    return decontamination.without_contaminated(docs, table(spark, folder, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token pieces with their sequence and place in it."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("SimHash near-dedup", one_of_near_copies),
    ("substring dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("best-fit packing", packed),
]

#: The classifier and the fingerprints can't be expressed in SQL; tests/llm compares the run with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages over ``documents``; each result is a table of the shared folder before the next one reads it."""
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, folder), f"pipeline-{name.replace(' ', '-')}")
    return docs
