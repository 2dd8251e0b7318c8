"""The named queries of the core and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from rolemill.plans import queries, queries_feeds, queries_state  # noqa: F401  (the last two add theirs)

QUERIES: dict[str, Callable] = queries.QUERIES
SQL: dict[str, str] = queries.SQL
FLAGSHIP = "match_topn"
