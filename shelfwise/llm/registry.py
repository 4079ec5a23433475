"""Queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from shelfwise.llm import chat, decontaminate, hardneg, mixing, neardup, periodic, quality, scoring, secret_scan, sharding, token_counts, topk, vectordup

MODULES = (chat, decontaminate, mixing, neardup, quality, scoring, secret_scan, sharding, token_counts, topk, vectordup, periodic, hardneg)


def queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
