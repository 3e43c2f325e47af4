"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from strata.llm import (
    byte_bpe, embedding_dedup, exact_dedup, hard_negatives, language_id, license_scan, lm_scoring, minhash_dedup, packing, periodic_runs, suffix_dedup,
    toxicity, url_lists,
)

QUERIES = {
    "op1_lm_scoring": lm_scoring.op1_lm_scoring,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_language_id": language_id.op4_language_id,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_minhash_dedup": minhash_dedup.op6_minhash_dedup,
    "op7_url_lists": url_lists.op7_url_lists,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_embedding_dedup": embedding_dedup.op9_embedding_dedup,
    "op10_best_fit_packing": packing.op10_best_fit_packing,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_toxicity": toxicity.op12_toxicity,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}

SQL = {"op3_exact_dedup": exact_dedup.OP3_SQL, "op7_url_lists": url_lists.OP7_SQL}
