"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    centroids, decontaminate, divergence, html_text, ngram_join, oracle, packing, quality, secrets, sharding,
    substrings, token_counts, token_files, toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_best_fit_packing": packing.op1_best_fit_packing,
        "op2_toxicity": toxicity.op2_toxicity,
        "op3_html_extraction": html_text.op3_html_extraction,
        "op4_token_counts": token_counts.op4_token_counts,
        "op5_quality_rules": quality.op5_quality_rules,
        "op6_secret_scans": secrets.op6_secret_scans,
        "op7_substring_dedup": substrings.op7_substring_dedup,
        "op8_benchmark_decontamination": decontaminate.op8_benchmark_decontamination,
        "op9_kd_sharding": sharding.op9_kd_sharding,
        "op10_ngram_jaccard_join": ngram_join.op10_ngram_jaccard_join,
        "op11_walsh_centroids": centroids.op11_walsh_centroids,
        "op12_bit_packed_ids": token_files.op12_bit_packed_ids,
        "op13_source_divergence": divergence.op13_source_divergence,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.oracle_sql()
