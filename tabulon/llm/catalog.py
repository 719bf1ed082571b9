"""The queries of this subpackage and their SQL twins."""
from __future__ import annotations

from tabulon.llm import bytebpe, chat, decontam, linededup, mainpart, merkle, mixing, prefixtrie, resample, simjoin, tokenfile, topk, toxicity

QUERIES = {
    "op1_top_k": topk.op1_top_k,
    "op2_chat_rotation": chat.op2_chat_rotation,
    "op3_decontamination": decontam.op3_decontamination,
    "op4_importance_resampling": resample.op4_importance_resampling,
    "op5_byte_bpe": bytebpe.op5_byte_bpe,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_main_text": mainpart.op7_main_text,
    "op8_token_file": tokenfile.op8_token_file,
    "op9_line_dedup": linededup.op9_line_dedup,
    "op10_jaccard_join": simjoin.op10_jaccard_join,
    "op11_prefix_trie": prefixtrie.op11_prefix_trie,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_source_mixing": mixing.op13_source_mixing,
}

SQL = {
    "op1_top_k": topk.SQL,
    "op2_chat_rotation": chat.SQL,
    "op3_decontamination": decontam.SQL,
    "op9_line_dedup": linededup.SQL,
    "op10_jaccard_join": simjoin.SQL,
    "op11_prefix_trie": prefixtrie.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_source_mixing": mixing.SQL,
}
