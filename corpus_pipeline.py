"""From raw documents to packed token ids, in stages that are stored one by one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ferrylog.llm import decontaminate, mixing, near_dedup, quality, token_binary
from ferrylog.llm.common import prepare, table
from ferrylog.llm.queries import BYTE_BPE
from ferrylog.session import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    prepare(spark)
    return quality.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    prepare(spark)
    return near_dedup.dedup_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, left out or repeated so that sources meet their weights."""
    prepare(spark)
    return mixing.mix_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bit-packed shards of token ids; one row per stored document, read from them."""
    prepare(spark)
    return token_binary.token_table(docs, BYTE_BPE)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_ids", token_ids),
]

#: Tokenizers and edit distances have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
