"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from hearthlift.llm.bin_slack import op13_minimum_bin_slack
from hearthlift.llm.bpe import op6_byte_bpe
from hearthlift.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from hearthlift.llm.language_id import op7_language_id
from hearthlift.llm.line_chunks import OP3_SQL, op3_line_chunk_dedup
from hearthlift.llm.merkle import OP12_SQL, op12_merkle_manifest
from hearthlift.llm.packing import op2_vector_packing
from hearthlift.llm.pair_search import OP11_SQL, op11_pair_bound_search
from hearthlift.llm.quality_classifier import op10_quality_classifier
from hearthlift.llm.quality_rules import OP1_SQL, op1_repetition_coverage
from hearthlift.llm.simhash import op8_simhash_near_dedup
from hearthlift.llm.suffix_index import op4_suffix_dedup
from hearthlift.llm.token_files import op5_token_files

QUERIES = {
    query.__name__: query
    for query in (
        op1_repetition_coverage,
        op2_vector_packing,
        op3_line_chunk_dedup,
        op4_suffix_dedup,
        op5_token_files,
        op6_byte_bpe,
        op7_language_id,
        op8_simhash_near_dedup,
        op9_exact_dedup,
        op10_quality_classifier,
        op11_pair_bound_search,
        op12_merkle_manifest,
        op13_minimum_bin_slack,
    )
}
ORACLES = {
    "op1_repetition_coverage": OP1_SQL,
    "op3_line_chunk_dedup": OP3_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_pair_bound_search": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
