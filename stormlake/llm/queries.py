"""The registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from . import (decontaminate, hard_negatives, jaccard_join, mixing, passage_dedup, prefix_trie, quality, shards, suffix_dedup, token_counts,
               token_ids, topk, warc)

QUERIES = {
    "op1_token_ids": token_ids.op1_token_ids,
    "op2_topk": topk.op2_topk,
    "op3_decontaminate": decontaminate.op3_decontaminate,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_shards": shards.op6_shards,
    "op7_mix": mixing.op7_mix,
    "op8_warc": warc.op8_warc,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_quality": quality.op10_quality,
    "op11_passage_dedup": passage_dedup.op11_passage_dedup,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
SQL = {
    "op2_topk": topk.OP2_SQL,
    "op3_decontaminate": decontaminate.OP3_SQL,
    "op4_jaccard_join": jaccard_join.OP4_SQL,
    "op5_suffix_dedup": suffix_dedup.OP5_SQL,
    "op6_shards": shards.OP6_SQL,
    "op8_warc": warc.OP8_SQL,
    "op11_passage_dedup": passage_dedup.OP11_SQL,
    "op12_hard_negatives": hard_negatives.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
