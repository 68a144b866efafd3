"""Registered queries of the training-data operators and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from plenaria.llm import (alignment, chat, decontaminate, embedding_dedup, jaccard_join, language, line_templates, manifest,
                          mixing, packing, pii, sharding, token_counts)

QUERIES = {
    "op1_pfair_mix": mixing.op1_pfair_mix,
    "op2_hyperplane_dedup": embedding_dedup.op2_hyperplane_dedup,
    "op3_edit_decontamination": decontaminate.op3_edit_decontamination,
    "op4_language_id": language.op4_language_id,
    "language_id_pages": language.language_id_pages,
    "op5_edit_aware_counts": token_counts.op5_edit_aware_counts,
    "op6_virtual_slots": sharding.op6_virtual_slots,
    "op7_line_templates": line_templates.op7_line_templates,
    "op8_weak_supervision_pii": pii.op8_weak_supervision_pii,
    "op9_chat_tokens": chat.op9_chat_tokens,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
    "op11_spill_alignment": alignment.op11_spill_alignment,
    "op12_interval_manifest": manifest.op12_interval_manifest,
    "op13_square_sum_packing": packing.op13_square_sum_packing,
}

ORACLE_SQL = {
    "op9_chat_tokens": chat.OP9_SQL,
    "op12_interval_manifest": manifest.OP12_SQL,
}
