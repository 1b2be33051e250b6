"""The registered query of each operator, and SQL where SQL can express it."""

from __future__ import annotations

from farelake.llm import (
    bpe,
    chat,
    divergence,
    html,
    jaccard,
    langmodel,
    packing,
    quality,
    secrets,
    topk,
    turntrie,
    word_bpe,
    wordpiece,
)

QUERIES = {
    "op1_quality_rules": quality.op1_quality_rules,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_jaccard_join": jaccard.op3_jaccard_join,
    "op4_exact_top_k": topk.op4_exact_top_k,
    "op5_cross_entropy_difference": langmodel.op5_cross_entropy_difference,
    "op6_secret_scans": secrets.op6_secret_scans,
    "op7_token_counts": wordpiece.op7_token_counts,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_html_extraction": html.op9_html_extraction,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_source_divergence": divergence.op11_source_divergence,
    "op12_word_bpe": word_bpe.op12_word_bpe,
    "op13_prefix_trie": turntrie.op13_prefix_trie,
}

ORACLE = {
    "op4_exact_top_k": topk.ORACLE,
    "op10_chat_formatting": chat.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
    "op13_prefix_trie": turntrie.ORACLE,
}
