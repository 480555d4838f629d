"""The queries of this package and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from cauce.llm.chat_format import OP11_SQL, op11_chat_format
from cauce.llm.decontaminate import OP8_SQL, op8_benchmark_decontamination
from cauce.llm.hash_forest import op10_hash_forest
from cauce.llm.jaccard_join import OP2_SQL, op2_ngram_jaccard
from cauce.llm.language import op4_language_id
from cauce.llm.line_templates import OP7_SQL, op7_line_templates
from cauce.llm.mixing import OP1_SQL, op1_mixing
from cauce.llm.shards import op9_sharding
from cauce.llm.spelling import OP12_SQL, op12_spelling_variants
from cauce.llm.token_counts import op5_token_counts
from cauce.llm.token_files import op3_token_files
from cauce.llm.toxicity import op6_toxicity
from cauce.llm.whitening import op13_whitening

QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_token_files": op3_token_files,
    "op4_language_id": op4_language_id,
    "op5_token_counts": op5_token_counts,
    "op6_toxicity": op6_toxicity,
    "op7_line_templates": op7_line_templates,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_sharding": op9_sharding,
    "op10_hash_forest": op10_hash_forest,
    "op11_chat_format": op11_chat_format,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
}

TWINS: dict[str, str] = {
    "op1_mixing": OP1_SQL,
    "op2_ngram_jaccard": OP2_SQL,
    "op7_line_templates": OP7_SQL,
    "op8_benchmark_decontamination": OP8_SQL,
    "op11_chat_format": OP11_SQL,
    "op12_spelling_variants": OP12_SQL,
}
