"""Registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from .ctw import op3_context_tree_weighting
from .decontaminate import op2_template_canonicalisation
from .infill import OP11_SQL, op11_indexable_skip_list
from .lines import OP5_SQL, op5_levelled_runs
from .minhash import op4_one_permutation
from .mixing import op8_temperature
from .neighbours import OP12_SQL, op12_one_bit_codes
from .pii import op7_information_theoretic
from .quality import op9_repetition_coverage
from .repeats import op1_paragraph_minhash
from .resampling import op13_prefix_crc
from .secrets import op10_token_efficiency
from .sharding import op6_kd_tree

QUERIES = {
    "op3_context_tree_weighting": op3_context_tree_weighting,
    "op1_paragraph_minhash": op1_paragraph_minhash,
    "op2_template_canonicalisation": op2_template_canonicalisation,
    "op4_one_permutation": op4_one_permutation,
    "op5_levelled_runs": op5_levelled_runs,
    "op6_kd_tree": op6_kd_tree,
    "op7_information_theoretic": op7_information_theoretic,
    "op8_temperature": op8_temperature,
    "op9_repetition_coverage": op9_repetition_coverage,
    "op10_token_efficiency": op10_token_efficiency,
    "op11_indexable_skip_list": op11_indexable_skip_list,
    "op12_one_bit_codes": op12_one_bit_codes,
    "op13_prefix_crc": op13_prefix_crc,
}
ORACLE_SQL = {"op5_levelled_runs": OP5_SQL, "op11_indexable_skip_list": OP11_SQL, "op12_one_bit_codes": OP12_SQL}
