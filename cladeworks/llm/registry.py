"""Queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

from cladeworks.llm import filter_audit, hash_forest, host_text, mixing, packing, pii, progressive_jpeg, rule_ensemble, simhash, suffix_dedup, token_alignment, toxicity, warc

QUERIES = {
    "op1_pii_spans": pii.op1_pii_spans,
    "op2_source_mix": mixing.op2_source_mix,
    "op3_simhash_dedup": simhash.op3_simhash_dedup,
    "op4_warc_dictionary": warc.op4_warc_dictionary,
    "op5_hilbert_pack": packing.op5_hilbert_pack,
    "op10_hash_forest": hash_forest.op10_hash_forest,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_progressive_jpeg": progressive_jpeg.op7_progressive_jpeg,
    "op8_host_text": host_text.op8_host_text,
    "op9_ordinal_toxicity": toxicity.op9_ordinal_toxicity,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_rule_ensemble": rule_ensemble.op13_rule_ensemble,
}

SQL = {
    "op2_source_mix": mixing.SQL,
    "op4_warc_dictionary": warc.SQL,
    "op6_suffix_dedup": suffix_dedup.SQL,
    "op11_filter_audit": filter_audit.SQL,
}
