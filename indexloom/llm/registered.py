"""All queries of the subpackage by name: (function, SQL or None)."""

from indexloom.llm import (
    ann, byte_bpe, conversations, hard_negatives, language_id, language_model, mixing, near_dup, quality, quality_rules, suffix_dedup, toxicity, url_filters,
)

MODULES = (
    ann, suffix_dedup, near_dup, quality, quality_rules, url_filters, language_model, toxicity, byte_bpe, mixing, conversations, language_id, hard_negatives,
)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
