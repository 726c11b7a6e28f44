"""Queries over the synthetic corpus tables, one per operator, and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import (
    divergence, fingerprints, language, licenses, mixing, oracles, packing, quality, sharding, simhash, suffix_dedup, token_counts,
    url_filters, whitening,
)
from .storage import documents

N_SHARDS = 24
PACKING_VOCABULARY = "byte_bpe_50k.json"
COUNTING_VOCABULARY = "piece_bpe_32k.model"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), N_SHARDS)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.judge(docs, model).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score"
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path(PACKING_VOCABULARY))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path(COUNTING_VOCABULARY))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint(documents(spark, sf_dir))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return language.identify(docs, language.learn(docs))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = suffix_dedup.removal_report(documents(spark, sf_dir), passage=None)
    return report.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_sharding, op2_simhash, op3_quality, op4_packing, op5_token_counts, op6_fingerprints,
        op7_mixing, op8_language, op9_suffix_dedup, op10_licenses, op11_whitening, op12_divergence, op13_url_filters,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_sharding": oracles.SHARDING, "op7_mixing": oracles.MIXING, "op9_suffix_dedup": oracles.SUFFIX_DEDUP,
        "op12_divergence": oracles.DIVERGENCE, "op13_url_filters": oracles.URL_FILTERS,
    }
