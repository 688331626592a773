"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from . import articles, bpe, conversations, fingerprints, language, mixing, negatives, quality, repeats, sharding, simhash, token_files, word_lm

QUERIES = {
    "op1_weighted_fingerprints": fingerprints.op1,
    "op2_language_codes": language.op2,
    "op3_source_mix": mixing.op3,
    "op4_quality_perplexity": quality.op4,
    "op5_byte_bpe_round_trip": bpe.op5,
    "op6_simhash_near_duplicates": simhash.op6,
    "op7_kd_tree_shards": sharding.op7,
    "op8_token_plane_files": token_files.op8,
    "op9_wrapper_articles": articles.op9,
    "op10_word_lm_scores": word_lm.op10,
    "op11_distance_key_negatives": negatives.op11,
    "op12_conversation_repair": conversations.op12,
    "op13_suffix_dedup": repeats.op13,
}

ORACLES: dict[str, str] = {
    "op11_distance_key_negatives": negatives.OP11_SQL,
    "op12_conversation_repair": conversations.OP12_SQL,
    "op13_suffix_dedup": repeats.OP13_SQL,
}
