"""The training-data queries and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from simcat.llm import (byte_cnn, circulant, digest_merge, lexical, licenses, one_bit, packing,
                        page_diff, pu_quality, rendezvous, repair, suffix_automaton, toxicity)

QUERIES = {
    "op1_license_scan": licenses.op1_license_scan,
    "op2_main_text": page_diff.op2_main_text,
    "op3_exact_dedup": digest_merge.op3_exact_dedup,
    "op4_quality": pu_quality.op4_quality,
    "op5_language": byte_cnn.op5_language,
    "op6_decontaminate": suffix_automaton.op6_decontaminate,
    "op7_minhash": circulant.op7_minhash,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_best_fit": packing.op9_best_fit,
    "op10_token_ids": repair.op10_token_ids,
    "op11_lexical_search": lexical.op11_lexical_search,
    "op12_sharding": rendezvous.op12_sharding,
    "op13_hard_negatives": one_bit.op13_hard_negatives,
}

ORACLES = {
    "op1_license_scan": licenses.oracle(),
    "op3_exact_dedup": digest_merge.ORACLE,
    "op6_decontaminate": suffix_automaton.ORACLE,
    "op11_lexical_search": lexical.ORACLE,
    "op12_sharding": rendezvous.ORACLE,
    "op13_hard_negatives": one_bit.ORACLE,
}
