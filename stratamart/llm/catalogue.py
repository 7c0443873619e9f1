"""The queries of this subpackage, each over whole tables, and the SQL they must equal where SQL can express them."""

from __future__ import annotations

from stratamart.llm import (
    alignment,
    bpe,
    jaccard_join,
    language_id,
    line_dedup,
    manifest,
    mixing,
    nearest,
    perplexity,
    quality_rules,
    sharding,
    token_counts,
    toxicity,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_perplexity": perplexity.op3_perplexity,
    "op4_nearest": nearest.op4_nearest,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_bpe": bpe.op6_bpe,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_sharding": sharding.op8_sharding,
    "op9_mixing": mixing.op9_mixing,
    "op10_language_id": language_id.op10_language_id,
    "op11_alignment": alignment.op11_alignment,
    "op12_manifest": manifest.op12_manifest,
    "op13_token_counts": token_counts.op13_token_counts,
}

ORACLE = {
    "op1_line_dedup": line_dedup.OP1_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op12_manifest": manifest.OP12_SQL,
}
