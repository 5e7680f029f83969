"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, language, mixing, neardup, pii, preference, quality, repeats, resample, runs, secrets, token_counts, tokens

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_ids": tokens.op1_token_ids,
    "op2_near_dedup": neardup.op2_near_dedup,
    "op3_pii": pii.op3_pii,
    "op4_preference_format": preference.op4_preference_format,
    "op5_repeats": repeats.op5_repeats,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_language_id": language.op7_language_id,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_token_counts": token_counts.op11_token_counts,
    "op12_resample": resample.op12_resample,
    "op13_periodic_runs": runs.op13_periodic_runs,
}

#: Only what SQL can express on whole tables; the others are tested against
#: brute-force versions in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op2_near_dedup": neardup.ORACLE,
    "op4_preference_format": preference.ORACLE,
    "op6_decontaminate": decontaminate.oracle(),
    "op12_resample": resample.ORACLE,
}
