"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from gridloom.llm import (
    bpe, contamination, conversations, fingerprints, html_text, near_dup, packed, quality, substrings, token_counts, toxicity, url_rules, whitening,
)

QUERIES = {
    "op1_byte_bpe": bpe.op1,
    "op2_decontaminate": contamination.op2,
    "op3_weighted_sampling": fingerprints.op3,
    "op4_token_counts": token_counts.op4,
    "op5_toxic_segments": toxicity.op5,
    "op6_minhash_join": near_dup.op6,
    "op7_main_text": html_text.op7,
    "op8_packed_ids": packed.op8,
    "op9_url_rules": url_rules.op9,
    "op10_suffix_trees": substrings.op10,
    "op11_weak_supervision": quality.op11,
    "op12_interval_repair": conversations.op12,
    "op13_weighted_whitening": whitening.op13,
}

ORACLE = {
    "op9_url_rules": url_rules.OP9_SQL, "op11_weak_supervision": quality.OP11_SQL, "op12_interval_repair": conversations.OP12_SQL,
}
