"""Registered queries of the subpackage: name -> (spark, sf_dir) -> DataFrame, and DuckDB SQL where SQL can say it."""

from __future__ import annotations

from martforge.llm import (ball_tree, bpe, decontaminate, exact_dedup, html_text, language_id, licenses, lm_score, quality, signature_join,
                           suffix_dedup, warc, whitening)

QUERIES = {
    "op1_bpe": bpe.op1_bpe,
    "op2_warc": warc.op2_warc,
    "op3_language_id": language_id.op3_language_id,
    "op4_jaccard_join": signature_join.op4_jaccard_join,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_lm_score": lm_score.op6_lm_score,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_extract_html": html_text.op8_extract_html,
    "op9_suffix_dedup": suffix_dedup.op9_suffix_dedup,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_exact_dedup": exact_dedup.op11_exact_dedup,
    "op12_whitening": whitening.op12_whitening,
    "op13_ranked_search": ball_tree.op13_ranked_search,
}

SQL = {
    "op2_warc": warc.ORACLE,
    "op4_jaccard_join": signature_join.ORACLE,
    "op5_quality_rules": quality.ORACLE,
    "op7_license_scan": licenses.ORACLE,
    "op9_suffix_dedup": suffix_dedup.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_exact_dedup": exact_dedup.ORACLE,
    "op13_ranked_search": ball_tree.ORACLE,
}
