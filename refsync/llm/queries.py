"""The queries of the subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from refsync.llm import decontaminate, embedding_dedup, html_text, jaccard_join, language_id, mixing, sharding, spelling, substring_dedup, suffix_dedup, token_alignment, token_counts, url_filter

_MODULES = (decontaminate, embedding_dedup, html_text, jaccard_join, language_id, mixing, sharding, spelling, substring_dedup, suffix_dedup, token_alignment, token_counts, url_filter)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
