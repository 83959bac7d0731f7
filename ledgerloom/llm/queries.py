"""The subpackage's registered queries, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversations, extraction, language, leaks, license_scan, line_chunks, mixing, near_join, outliers, packing, runs, secret_ledger, token_files


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": token_files.op1_token_files,
        "op2_chosen_path_join": near_join.op2_chosen_path_join,
        "op3_robust_outliers": outliers.op3_robust_outliers,
        "op4_line_chunks": line_chunks.op4_line_chunks,
        "op5_license_digests": license_scan.op5_license_digests,
        "op6_language_id": language.op6_language_id,
        "op7_block_labeller": extraction.op7_block_labeller,
        "op8_best_fit_packing": packing.op8_best_fit_packing,
        "op9_edit_leaks": leaks.op9_edit_leaks,
        "op10_secret_ledger": secret_ledger.op10_secret_ledger,
        "op11_source_mix": mixing.op11_source_mix,
        "op12_periodic_runs": runs.op12_periodic_runs,
        "op13_conversation_repair": conversations.op13_conversation_repair,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_license_digests": license_scan.oracle()}
