"""The numbered queries over the test tables, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrollspark.llm import balltree, decisions, mixing, orchard, packing, pcatiles, preference, rules, secrets, segments, sharding, simhash, toxicity
from enrollspark.llm.common import crc_bucket, read_table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    return secrets.secret_digest(read_table(spark, d, "documents"))


def op2_quality_classifier(spark: SparkSession, d: str) -> DataFrame:
    docs, held = read_table(spark, d, "documents"), crc_bucket(F.col("doc_id"), 5) == 0
    model = rules.learn_quality(docs, read_table(spark, d, "labels"), ~held)
    scored = rules.score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= rules.POINT).cast("int").alias("predicted"))


def op3_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, d, "documents"))


def op4_exact_topk(spark: SparkSession, d: str) -> DataFrame:
    return balltree.embedding_top(read_table(spark, d, "embeddings"))


def op5_source_mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, d, "documents").select("doc_id", "source"))


def op6_simhash_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, d, "documents"))


def op7_toxicity(spark: SparkSession, d: str) -> DataFrame:
    docs, held = read_table(spark, d, "documents"), crc_bucket(F.col("doc_id"), 4) == 2
    model = toxicity.learn_toxicity(docs, read_table(spark, d, "labels"), ~held)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= toxicity.POINT).cast("int").alias("predicted"))


def op8_preference_format(spark: SparkSession, d: str) -> DataFrame:
    conversations = read_table(spark, d, "conversations")
    return preference.format_pairs(conversations, preference.neighbour_pairs(conversations))


def op9_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    learn = crc_bucket(F.col("doc_id"), 5) != 0
    return decisions.judge(read_table(spark, d, "documents"), read_table(spark, d, "labels"), learn)


def op10_sharding(spark: SparkSession, d: str) -> DataFrame:
    return sharding.place_documents(read_table(spark, d, "documents"))


def op11_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    return segments.embedding_negatives(read_table(spark, d, "embeddings"))


def op12_embedding_near_dedup(spark: SparkSession, d: str) -> DataFrame:
    return pcatiles.near_vectors(read_table(spark, d, "embeddings"))


def op13_vector_codes(spark: SparkSession, d: str) -> DataFrame:
    return orchard.compress(read_table(spark, d, "embeddings"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_quality_classifier,
        op3_best_fit_packing,
        op4_exact_topk,
        op5_source_mixing,
        op6_simhash_near_dedup,
        op7_toxicity,
        op8_preference_format,
        op9_quality_rules,
        op10_sharding,
        op11_hard_negatives,
        op12_embedding_near_dedup,
        op13_vector_codes,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_topk": balltree.ORACLE,
    "op8_preference_format": preference.ORACLE,
    "op11_hard_negatives": segments.ORACLE,
    "op12_embedding_near_dedup": pcatiles.ORACLE,
    "op13_vector_codes": orchard.ORACLE,
}
