"""Queries of this subpackage and their SQL, for the driver's entry module."""

from __future__ import annotations

from .decontamination import op8_benchmark_decontamination
from .embedding_dedup import OP2_SQL, op2_embedding_near_dedup
from .lexical_search import OP11_SQL, op11_ranked_lexical_search
from .lm_scoring import op3_lm_scoring
from .mixing import OP12_SQL, op12_source_mixing
from .ngram_join import OP4_SQL, op4_ngram_jaccard_join
from .packing import op6_best_fit_packing
from .prefix_trie import OP13_SQL, op13_conversation_prefix_trie
from .quality_classifier import op10_quality_classifier
from .sharding import op1_sharding
from .substring_dedup import op9_substring_dedup
from .suffix_dedup import op5_suffix_array_dedup
from .warc import OP7_SQL, op7_warc

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_suffix_array_dedup": op5_suffix_array_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_warc": op7_warc,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_ranked_lexical_search": op11_ranked_lexical_search,
    "op12_source_mixing": op12_source_mixing,
    "op13_conversation_prefix_trie": op13_conversation_prefix_trie,
}
SQL = {"op2_embedding_near_dedup": OP2_SQL, "op4_ngram_jaccard_join": OP4_SQL, "op7_warc": OP7_SQL, "op11_ranked_lexical_search": OP11_SQL, "op12_source_mixing": OP12_SQL, "op13_conversation_prefix_trie": OP13_SQL}
