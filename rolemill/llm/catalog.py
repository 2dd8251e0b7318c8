"""All queries of the subpackage and their SQL counterparts, by problem."""

from __future__ import annotations

from rolemill.llm import queries_dedup, queries_text, queries_values, queries_vectors

_MODULES = (queries_values, queries_dedup, queries_vectors, queries_text)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL = {k: v for m in _MODULES for k, v in m.SQL.items()}
