"""The registered queries of this subpackage: one thin query per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import filter_audit, fingerprints, lm_scoring, mixing, near_dedup, packing, passage_dedup, quality_rules, secrets, suffix_dedup, token_store, turn_repair, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_array_dedup": suffix_dedup.op1,
        "op2_document_fingerprints": fingerprints.op2,
        "op3_quality_rules": quality_rules.op3,
        "op4_token_id_output": token_store.op4,
        "op5_lm_scoring": lm_scoring.op5,
        "op6_best_fit_packing": packing.op6,
        "op7_warc": warc.op7,
        "op8_secret_scans": secrets.op8,
        "op9_simhash_near_dedup": near_dedup.op9,
        "op10_source_mixing": mixing.op10,
        "op11_turn_repair": turn_repair.op11,
        "op12_passage_dedup": passage_dedup.op12,
        "op13_filter_audit": filter_audit.op13,
    }
