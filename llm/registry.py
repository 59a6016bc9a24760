"""Registered queries of the subpackage and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from llm import collocations, filter_audit
from llm.bpe import op1_byte_bpe
from llm.collocations import op13_collocations
from llm.decontaminate import op3_decontaminate
from llm.filter_audit import op12_filter_audit
from llm.html_text import op8_html_text
from llm.language_model import op10_lm_score
from llm.near_dedup import op2_near_dedup
from llm.packing import op11_packing
from llm.quality_model import op5_quality_classifier
from llm.quality_rules import op9_quality_rules
from llm.secrets import op7_secret_scans
from llm.token_counts import op6_token_counts
from llm.url_filter import op4_url_filter

QUERIES: dict[str, Callable] = {
    function.__name__: function
    for function in (
        op1_byte_bpe,
        op2_near_dedup,
        op3_decontaminate,
        op4_url_filter,
        op5_quality_classifier,
        op6_token_counts,
        op7_secret_scans,
        op8_html_text,
        op9_quality_rules,
        op10_lm_score,
        op11_packing,
        op12_filter_audit,
        op13_collocations,
    )
}

# Operators without an entry have no SQL form: learned scores, tokenizers, similarity search.
ORACLES: dict[str, str] = {
    "op12_filter_audit": filter_audit.ORACLE_SQL,
    "op13_collocations": collocations.ORACLE_SQL,
}
