"""Registered queries of this subpackage."""

from __future__ import annotations


from pulcra.llm.apportion import op7_source_mixing
from pulcra.llm.chat_render import op3_chat_rendering
from pulcra.llm.context_mixing import op10_context_mixing
from pulcra.llm.filter_audit import op12_filter_audit
from pulcra.llm.language_mixture import op1_language_mixture
from pulcra.llm.line_frequency import op6_line_frequency
from pulcra.llm.oracle import ORACLE
from pulcra.llm.packing import op9_best_fit_packing
from pulcra.llm.pq_dedup import op2_product_quantisation
from pulcra.llm.secret_scan import op13_secret_scan
from pulcra.llm.simhash_pivot import op5_simhash_pivots
from pulcra.llm.spelling_variants import op11_spelling_variants
from pulcra.llm.token_counts import op8_token_counts
from pulcra.llm.token_files import op4_token_files

QUERIES = {
    f.__name__: f
    for f in (
        op1_language_mixture,
        op2_product_quantisation,
        op3_chat_rendering,
        op4_token_files,
        op5_simhash_pivots,
        op6_line_frequency,
        op7_source_mixing,
        op8_token_counts,
        op9_best_fit_packing,
        op10_context_mixing,
        op11_spelling_variants,
        op12_filter_audit,
        op13_secret_scan,
    )
}
