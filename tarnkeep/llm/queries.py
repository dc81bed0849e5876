"""The registered queries of this subpackage, with their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tarnkeep.llm import (
    decontaminate, language, merkle, packing, rans, repair, repeats, secrets, shards, simhash,
    suffix_tree, tour, urls,
)
from tarnkeep.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.report(table(spark, sf, "documents"))


def op2_suffix_tree_score(spark: SparkSession, sf: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf, "documents"))


def op3_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return language.report(table(spark, sf, "documents"))


def op4_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"))


def op5_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack(table(spark, sf, "documents"))


def op6_simhash_components(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.report(table(spark, sf, "documents"))


def op7_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op8_token_files(spark: SparkSession, sf: str) -> DataFrame:
    return rans.round_trip(table(spark, sf, "documents"))


def op9_repeated_strings(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.report(table(spark, sf, "documents"))


def op10_merkle_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.report(table(spark, sf, "documents"))


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair.report(table(spark, sf, "conversations"))


def op12_conversation_trie(spark: SparkSession, sf: str) -> DataFrame:
    return tour.report(table(spark, sf, "conversations"))


def op13_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return shards.report(table(spark, sf, "documents"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_suffix_tree_score, op3_language_id, op4_url_filter,
        op5_best_fit_packing, op6_simhash_components, op7_decontamination, op8_token_files,
        op9_repeated_strings, op10_merkle_fingerprints, op11_conversation_repair, op12_conversation_trie,
        op13_sharding, pipeline,
    )
}
ORACLES: dict[str, str] = {}
