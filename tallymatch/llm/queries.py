"""Registered queries of this subpackage, each with its SQL where SQL can say it."""

from . import (
    bit_planes,
    byte_bpe,
    chat,
    collocations,
    exact_dedup,
    fill_in_middle,
    html_text,
    minhash,
    packing,
    quality_classifier,
    quality_rules,
    token_join,
    toxicity,
)

MODULES = (
    byte_bpe,
    quality_rules,
    minhash,
    quality_classifier,
    toxicity,
    chat,
    bit_planes,
    exact_dedup,
    packing,
    html_text,
    collocations,
    token_join,
    fill_in_middle,
)


def llm_queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def llm_sql():
    return {name: sql.strip() for module in MODULES for name, sql in module.SQL.items()}
