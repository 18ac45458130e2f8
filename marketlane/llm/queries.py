"""The training-data operators over whole tables, by query name, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlane.llm import (
    ann,
    decontamination,
    hard_negatives,
    language_model,
    packing,
    personal_data,
    quality,
    sharding,
    simhash,
    substring,
    toxicity,
    url_trust,
    whitening,
)
from marketlane.llm.common import table
from marketlane.llm.sql import CHECKS  # noqa: F401

#: Every row whose id it divides is a nearest-neighbour query.
QUERY_STEP = 20

#: Words of the longest n-grams of the language model.
LM_ORDER = 3

#: Every row whose id it divides is an anchor of hard-negative mining.
ANCHOR_STEP = 50


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substring.dedup_report(table(spark, folder, "documents"))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def op5_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_trust.url_verdicts(table(spark, folder, "pages"))


def op6_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, folder, "documents"))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op8_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.scores(table(spark, folder, "documents"), LM_ORDER)


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.search_every(table(spark, folder, "embeddings"), QUERY_STEP)


def op11_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data.personal_data(table(spark, folder, "documents"))


def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(table(spark, folder, "embeddings"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mine(table(spark, folder, "embeddings"), ANCHOR_STEP, hard_negatives.relabelled())


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_best_fit_packing,
        op3_benchmark_decontamination,
        op4_simhash_near_dedup,
        op5_url_filters,
        op6_sharding,
        op7_toxicity,
        op8_lm_scoring,
        op9_quality_classifier,
        op10_nearest_neighbours,
        op11_personal_data,
        op12_embedding_whitening,
        op13_hard_negatives,
    )
}
