"""The queries of this subpackage and, where SQL can express them, their DuckDB forms."""

from __future__ import annotations

from rivulet.llm import (
    alignment,
    fingerprints,
    language_id,
    line_dedup,
    mixing,
    near_dedup,
    neighbours,
    packing,
    secrets,
    substring_dedup,
    token_count,
    token_files,
    vector_codes,
)


def queries() -> dict:
    return {
        "op1_line_dedup": line_dedup.op1_line_dedup,
        "op2_pack": packing.op2_pack,
        "op3_secrets": secrets.op3_secrets,
        "op4_fingerprints": fingerprints.op4_fingerprints,
        "op5_nearest": neighbours.op5_nearest,
        "op6_near_dedup": near_dedup.op6_near_dedup,
        "op7_language_id": language_id.op7_language_id,
        "op8_token_count": token_count.op8_token_count,
        "op9_substring_dedup": substring_dedup.op9_substring_dedup,
        "op10_mix": mixing.op10_mix,
        "op11_vector_codes": vector_codes.op11_vector_codes,
        "op12_alignment": alignment.op12_alignment,
        "op13_token_files": token_files.op13_token_files,
    }


def oracle_sql() -> dict:
    return {"op1_line_dedup": line_dedup.SQL, "op9_substring_dedup": substring_dedup.SQL, "op11_vector_codes": vector_codes.SQL}
