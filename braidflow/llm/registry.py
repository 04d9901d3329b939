"""The queries of this subpackage and the SQL for those that SQL can express."""

from __future__ import annotations

from braidflow.llm import decontamination, jaccard_join, license_scan, lm_scoring, packing, pii, token_output, topk_search, toxicity, warc

_QUERIES = [
    license_scan.op1_license_scan,
    lm_scoring.op2_lm_scoring,
    warc.op3_warc,
    jaccard_join.op4_jaccard_join,
    packing.op5_packing,
    topk_search.op6_topk_search,
    pii.op7_pii,
    token_output.op8_token_output,
    toxicity.op9_toxicity,
    decontamination.op10_decontamination,
]
_SQL = {
    "op3_warc": warc.ORACLE_SQL,
    "op6_topk_search": topk_search.ORACLE_SQL,
    "op4_jaccard_join": jaccard_join.ORACLE_SQL,
    "op10_decontamination": decontamination.ORACLE_SQL,
}


def queries() -> dict:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
