"""All named queries of the core, with the equivalent SQL where there is one."""

from __future__ import annotations

from gleaner.plans import aggregates, base, content, filters, general, join_queries, ranking, source_queries, stream_queries  # noqa: F401

QUERIES = {**base.QUERIES, **general.QUERIES}
ORACLE = {**base.ORACLE, **general.ORACLE}
