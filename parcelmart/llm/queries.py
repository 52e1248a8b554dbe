"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelmart.llm.alignment import op11_pair_alignment
from parcelmart.llm.bpe import op4_speculative_bpe
from parcelmart.llm.common import with_code
from parcelmart.llm.exact_dedup import OP6_SQL, op6_trie_owners
from parcelmart.llm.html_template import op10_template_slots
from parcelmart.llm.jaccard_join import op3_count_tree_join
from parcelmart.llm.licenses import op1_license_scan
from parcelmart.llm.merkle import OP12_SQL, op12_merkle_proofs
from parcelmart.llm.packing import op8_concat_and_cut
from parcelmart.llm.quality_classifier import op5_hierarchical_quality
from parcelmart.llm.quality_rules import op2_line_rules
from parcelmart.llm.sharding import op9_virtual_slots
from parcelmart.llm.token_matrix import op7_best_fit_matrix
from parcelmart.llm.top_k import OP13_SQL, op13_maxscore


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    queries = {
        "op1_license_scan": op1_license_scan,
        "op2_line_rules": op2_line_rules,
        "op3_count_tree_join": op3_count_tree_join,
        "op4_speculative_bpe": op4_speculative_bpe,
        "op5_hierarchical_quality": op5_hierarchical_quality,
        "op6_trie_owners": op6_trie_owners,
        "op7_best_fit_matrix": op7_best_fit_matrix,
        "op8_concat_and_cut": op8_concat_and_cut,
        "op9_virtual_slots": op9_virtual_slots,
        "op10_template_slots": op10_template_slots,
        "op11_pair_alignment": op11_pair_alignment,
        "op12_merkle_proofs": op12_merkle_proofs,
        "op13_maxscore": op13_maxscore,
    }
    return {name: with_code(query) for name, query in queries.items()}


def check_sql() -> dict[str, str]:
    return {"op6_trie_owners": OP6_SQL, "op12_merkle_proofs": OP12_SQL, "op13_maxscore": OP13_SQL}
