"""The queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from strataglean.llm import (
    alignment,
    bpe,
    decontaminate,
    line_dedup,
    lm,
    minhash,
    quality_classifier,
    quality_rules,
    secret_scan,
    simhash,
    token_counts,
    warc,
    whitening,
)

QUERIES = {
    "op1_simhash_near_dedup": simhash.op1_simhash_near_dedup,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_benchmark_decontamination": decontaminate.op3_benchmark_decontamination,
    "op4_quality_classifier": quality_classifier.op4_quality_classifier,
    "op5_secret_scan": secret_scan.op5_secret_scan,
    "op6_line_dedup": line_dedup.op6_line_dedup,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_quality_rules": quality_rules.op8_quality_rules,
    "op9_warc_fixity": warc.op9_warc_fixity,
    "op10_lm_scoring": lm.op10_lm_scoring,
    "op10_lm_scoring_long": lm.op10_lm_scoring_long,
    "op11_embedding_whitening": whitening.op11_embedding_whitening,
    "op12_minhash_near_dedup": minhash.op12_minhash_near_dedup,
    "op13_cross_tokenizer_alignment": alignment.op13_cross_tokenizer_alignment,
}

ORACLES: dict[str, str] = {
    "op5_secret_scan": secret_scan.ORACLE,
    "op8_quality_rules": quality_rules.ORACLE,
    "op9_warc_fixity": warc.ORACLE,
    "op10_lm_scoring": lm.ORACLE,
}
