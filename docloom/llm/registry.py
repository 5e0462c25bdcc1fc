"""The operators' queries and their SQL."""

from __future__ import annotations

from . import chat_format, conversation_repair, decontamination, fingerprint_index, group_packing, itemsets, packing, pii, quality_classifier, quality_rules, simhash, suffix_dedup, token_output

_MODULES = (chat_format, conversation_repair, decontamination, fingerprint_index, group_packing, itemsets, packing, pii, quality_classifier, quality_rules, simhash, suffix_dedup, token_output)


def queries() -> dict:
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _MODULES for k, s in m.ORACLE.items()}
