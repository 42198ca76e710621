"""Registered queries: each operator run over the given tables, with its SQL counterpart."""

from __future__ import annotations

from . import catalog_queries, metric_queries, stat_queries, text_queries, vector_queries

_MODULES = (text_queries, stat_queries, catalog_queries, vector_queries, metric_queries)


def all_queries() -> dict:
    return {name: run for m in _MODULES for name, (run, _) in m.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, (_, sql) in m.QUERIES.items() if sql is not None}
