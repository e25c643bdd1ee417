"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, chat_format, embedding_dedup, exact_dedup, jaccard_join, language_id, license_scan, packing, periodic_runs, substring_dedup, top_k, toxicity, vector_codes


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_exact_dedup": exact_dedup.query,
        "op2_best_fit_packing": packing.query,
        "op3_embedding_dedup": embedding_dedup.query,
        "op4_license_scan": license_scan.query,
        "op5_jaccard_join": jaccard_join.query,
        "op6_language_id": language_id.query,
        "op7_chat_format": chat_format.query,
        "op8_substring_dedup": substring_dedup.query,
        "op9_byte_bpe": byte_bpe.query,
        "op10_toxicity": toxicity.query,
        "op11_periodic_runs": periodic_runs.query,
        "op12_vector_codes": vector_codes.query,
        "op13_top_k": top_k.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.ORACLE,
        "op3_embedding_dedup": embedding_dedup.ORACLE,
        "op4_license_scan": license_scan.ORACLE,
        "op5_jaccard_join": jaccard_join.ORACLE,
        "op7_chat_format": chat_format.ORACLE,
        "op8_substring_dedup": substring_dedup.ORACLE,
        "op11_periodic_runs": periodic_runs.ORACLE,
        "op12_vector_codes": vector_codes.ORACLE,
        "op13_top_k": top_k.ORACLE,
    }
