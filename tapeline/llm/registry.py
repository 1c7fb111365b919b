"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from . import exact_dedup, html, jaccard, langid, media, merkle, mixing, packing, pieces, tokens, trie, urlfilter

QUERIES = {
    "op1_source_mix": mixing.op1_source_mix,
    "op2_media_columns": media.op2_media_columns,
    "op3_url_filter": urlfilter.op3_url_filter,
    "op4_token_counts": tokens.op4_token_counts,
    "op5_jaccard_join": jaccard.op5_jaccard_join,
    "op6_main_text": html.op6_main_text,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_token_matrix": packing.op8_token_matrix,
    "op9_best_fit": packing.op9_best_fit,
    "op10_language_id": langid.op10_language_id,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_conversation_trie": trie.op12_conversation_trie,
    "op13_piece_codec": pieces.op13_piece_codec,
}

ORACLE_SQL = {"op1_source_mix": mixing.ORACLE, "op3_url_filter": urlfilter.ORACLE, "op7_exact_dedup": exact_dedup.ORACLE, "op11_merkle_manifest": merkle.ORACLE, "op12_conversation_trie": trie.ORACLE}
