"""The registered queries of the document operators, with the SQL that states them where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import conversation_repair, decontamination, language_id, near_dedup, packing, periodic_runs, quality, quality_classifier, secrets, substring_dedup, suffix_dedup, token_counts, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scans": secrets.query,
        "op2_language_id": language_id.query,
        "op3_suffix_dedup": suffix_dedup.query,
        "op4_best_fit_packing": packing.query,
        "op5_substring_dedup": substring_dedup.query,
        "op6_toxicity": toxicity.query,
        "op7_decontamination": decontamination.query,
        "op8_quality_rules": quality.query,
        "op9_minhash_near_dedup": near_dedup.query,
        "op10_token_counts": token_counts.query,
        "op13_periodic_runs": periodic_runs.query,
        "op11_quality_classifier": quality_classifier.query,
        "op12_conversation_repair": conversation_repair.query,
    }


def oracle_sql() -> dict[str, str]:
    return {"op12_conversation_repair": conversation_repair.oracle_sql()}
