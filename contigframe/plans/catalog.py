"""All queries of the library: importing the query modules fills the registry."""

from __future__ import annotations

from contigframe.plans import annotate_queries, hit_queries, interval_queries, registry, scalar_queries, search_queries, sequence_queries, sink_queries, source_queries

MODULES = (scalar_queries, sequence_queries, interval_queries, hit_queries, source_queries, sink_queries, annotate_queries, search_queries)


def queries() -> dict[str, registry.Query]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.ORACLES)
