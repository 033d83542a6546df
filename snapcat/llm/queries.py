"""Queries of the operators and their SQL."""

from __future__ import annotations

import corpus_pipeline
from snapcat.llm import (
    collocations, decontaminate, embedding_dedup, html_text, jaccard, langid, line_dedup, lm, packing, pii, prefix_trie, quality, token_files)

QUERIES = {
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_embedding_dedup": embedding_dedup.op2_embedding_dedup,
    "op3_language_id": langid.op3_language_id,
    "op4_token_files": token_files.op4_token_files,
    "op5_html_text": html_text.op5_html_text,
    "op6_ngram_jaccard": jaccard.op6_ngram_jaccard,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_quality": quality.op8_quality,
    "op9_pii": pii.op9_pii,
    "op10_lm_scoring": lm.op10_lm_scoring,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_collocations": collocations.op12_collocations,
    "op13_line_dedup": line_dedup.op13_line_dedup,
    "pipeline": corpus_pipeline.run,
}

#: The other queries are tested against brute force: SQL cannot express them.
SQL = {
    "op2_embedding_dedup": embedding_dedup.OP2_SQL,
    "op7_decontaminate": decontaminate.OP7_SQL,
    "op11_prefix_trie": prefix_trie.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
    "op13_line_dedup": line_dedup.OP13_SQL,
}
