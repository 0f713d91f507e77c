"""The queries of this subpackage and the SQL that some are held against."""

from __future__ import annotations

from graniteloom.llm import chat, jaccard, mixing, packing, pii, quality, repeats, search, secrets, toxicity

_QUERIES = {
    "op1_toxicity_svm": toxicity.op1_toxicity_svm,
    "op2_pii_anchors": pii.op2_pii_anchors,
    "op3_quality_rules": quality.op3_quality_rules,
    "op4_bm25_top_k": search.op4_bm25_top_k,
    "op5_ngram_jaccard": jaccard.op5_ngram_jaccard,
    "op6_chat_formatting": chat.op6_chat_formatting,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_repeated_strings": repeats.op8_repeated_strings,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op10_source_mixing": mixing.op10_source_mixing,
}
_SQL = {
    "op3_quality_rules": quality.OP3_SQL,
    "op6_chat_formatting": chat.OP6_SQL,
}


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict:
    return dict(_SQL)
