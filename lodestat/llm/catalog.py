"""Registered queries of the training-text operators, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from lodestat.llm import (
    context_mixing,
    conversation_repair,
    count_transducer,
    decontaminate,
    exact_dedup,
    jaccard_join,
    packing,
    prefix_bpe,
    prefix_trie,
    secret_scan,
    sentence_spans,
    toxicity,
    url_filters,
)

QUERIES = {
    "op1_context_mixing": context_mixing.op1_context_mixing,
    "op2_ownership_secrets": secret_scan.op2_ownership_secrets,
    "op3_count_transducer": count_transducer.op3_count_transducer,
    "op4_prefix_bpe": prefix_bpe.op4_prefix_bpe,
    "op5_sentence_spans": sentence_spans.op5_sentence_spans,
    "op6_size_aware_jaccard": jaccard_join.op6_size_aware_jaccard,
    "op7_url_filters": url_filters.op7_url_filters,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_winnowing": decontaminate.op9_winnowing,
    "op10_gru_toxicity": toxicity.op10_gru_toxicity,
    "op11_dominance_packing": packing.op11_dominance_packing,
    "op12_survivor_repair": conversation_repair.op12_survivor_repair,
    "op13_ternary_trie": prefix_trie.op13_ternary_trie,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op7_url_filters": url_filters.OP7_SQL,
    "op8_exact_dedup": exact_dedup.OP8_SQL,
    "op9_winnowing": decontaminate.OP9_SQL,
    "op12_survivor_repair": conversation_repair.OP12_SQL,
    "op13_ternary_trie": prefix_trie.OP13_SQL,
}
