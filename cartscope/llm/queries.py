"""The operators as queries over ``documents``, and the SQL of those SQL can express."""

from __future__ import annotations

from cartscope.llm import filter_audit, near_dedup, secret_scan, substring_dedup
from cartscope.llm.decontaminate import op1_decontamination
from cartscope.llm.filter_audit import op11_filter_audit
from cartscope.llm.language_id import op5_language_id
from cartscope.llm.lm_score import op4_lm_score
from cartscope.llm.near_dedup import op3_minhash_dedup
from cartscope.llm.packing import op2_packing
from cartscope.llm.pii import op10_pii
from cartscope.llm.quality import op8_quality_rules
from cartscope.llm.secret_scan import op9_secret_scan
from cartscope.llm.substring_dedup import op7_substring_dedup
from cartscope.llm.suffix_dedup import op12_suffix_dedup
from cartscope.llm.token_alignment import op13_token_alignment
from cartscope.llm.toxicity import op6_toxicity

QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_packing, op3_minhash_dedup, op4_lm_score, op5_language_id,
    op6_toxicity, op7_substring_dedup, op8_quality_rules, op9_secret_scan, op10_pii,
    op11_filter_audit, op12_suffix_dedup, op13_token_alignment)}

ORACLE_SQL = {
    "op3_minhash_dedup": near_dedup.ORACLE_SQL,
    "op7_substring_dedup": substring_dedup.ORACLE_SQL,
    "op9_secret_scan": secret_scan.ORACLE_SQL,
    "op11_filter_audit": filter_audit.ORACLE_SQL,
}
