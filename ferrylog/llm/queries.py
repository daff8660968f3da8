"""Registered queries of the text operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ferrylog.llm import (
    decontaminate,
    fingerprints,
    html_extract,
    mixing,
    near_dedup,
    periodic_runs,
    quality,
    secret_scan,
    spelling,
    suffix_dedup,
    surrogates,
    token_binary,
    token_count,
)
from ferrylog.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")


def op1_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary.token_table(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scanned(table(spark, sf_dir, "documents"))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.dedup_table(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.counted(table(spark, sf_dir, "documents"), PIECE_BPE)


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_table(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.private_texts(table(spark, sf_dir, "documents"))


def op9_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.page_texts(table(spark, sf_dir, "pages"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_table(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_table(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_table(table(spark, sf_dir, "documents"))


def op13_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_table(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_binary,
        op2_quality_rules,
        op3_secret_scan,
        op4_near_dedup,
        op5_token_counts,
        op6_source_mix,
        op7_decontamination,
        op8_pii_surrogates,
        op9_page_text,
        op10_suffix_dedup,
        op11_periodic_runs,
        op12_spelling_variants,
        op13_fingerprints,
    )
}

#: Queries that SQL can express.
CHECKS: dict[str, str] = {
    "op2_quality_rules": quality.SQL,
    "op12_spelling_variants": spelling.SQL,
}
