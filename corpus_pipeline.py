"""A corpus pipeline over ``documents``: quality, near duplicates, secrets, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's docs. All but the last return the columns
of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from enrollspark.llm import mixing, packing, rules, secrets, simhash
from enrollspark.llm.common import crc_bucket, read_table, stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    Null and empty texts are scored by their zero statistics; repeated rows are kept or go together;
    without labels nothing is learnt and all rows score alike. An empty table stays empty.
    """
    held = crc_bucket(F.col("doc_id"), 5) == 0
    model = rules.learn_quality(docs, read_table(spark, sf_dir, "labels"), ~held)
    return rules.filter_quality(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest doc_id, null after all others.

    Texts without words have one fingerprint and are one group. A repeated id in two groups
    stays in both; of repeated rows one stays. An empty table stays empty.
    """
    return simhash.drop_near_duplicates(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts, and n_chars follows the text.

    All rows stay, repeated ones and null ids included; null and empty texts stay as they are.
    """
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in the order of the mixed stream; the files in name order are the stream.

    All rows stay. A null source is a source; of an id with several sources the first in order
    counts, and rows without an id come last. An empty table stays empty.
    """
    return mixing.mixed_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in sequences, which follow the mixed stream.

    Null and empty texts are one piece, their end; repeated rows are packed as often as they come.
    An empty table gives no pieces.
    """
    return packing.pack_stream(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("secret_scan", secret_scan), ("mix", mix), ("pack", pack)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, f in STAGES:
        docs = stage(f(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
