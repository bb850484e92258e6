"""Registered queries of this subpackage: each applies one operator, with its production parameters, to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    op1_kneser_ney,
    op2_line_dedup,
    op3_html,
    op4_simhash,
    op5_packing,
    op6_language,
    op7_decontaminate,
    op8_sharding,
    op9_substring,
    op10_rules,
    op11_suffixes,
    op12_resample,
    op13_divergence,
)
from .common import ship_code, table


def op1_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_kneser_ney.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_winnow_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op2_line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", "text")


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_html.main_text(table(spark, sf_dir, "pages"))


def op4_simhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = op4_simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", op4_simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op5_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_packing.pack(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return op6_language.identify(docs).select("doc_id", "held_out", "lang_pred", "score")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = op7_decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "item_id", "n_shingles", "n_found", "containment")


def op8_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_sharding.assign(table(spark, sf_dir, "documents")).drop("group_key")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op9_substring.dedup_passages(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op11_suffixes.dedup_substrings(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op12_resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES = [
    op1_kneser_ney_quality,
    op2_winnow_line_dedup,
    op3_html_main_text,
    op4_simhash_near_duplicates,
    op5_pack_sequences,
    op6_language_id,
    op7_benchmark_decontamination,
    op8_balanced_shards,
    op9_substring_dedup,
    op10_quality_rules,
    op11_suffix_array_dedup,
    op12_importance_resampling,
    op13_source_divergence,
]


def _with_code(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_code(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {fn.__name__: _with_code(fn) for fn in QUERIES} | {"pipeline": _with_code(corpus_pipeline.run)}


def oracle_sql() -> dict[str, str]:
    return {
        "op2_winnow_line_dedup": op2_line_dedup.ORACLE_SQL,
        "op7_benchmark_decontamination": op7_decontaminate.ORACLE_SQL,
        "op9_substring_dedup": op9_substring.ORACLE_SQL,
        "op10_quality_rules": op10_rules.ORACLE_SQL,
        "op11_suffix_array_dedup": op11_suffixes.ORACLE_SQL,
        "op13_source_divergence": op13_divergence.ORACLE_SQL,
    }
