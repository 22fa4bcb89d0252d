"""Every operator as a query over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from tidemark.queries import checks, events, graphs, labels, runs, texts, tickets, traces

_MODULES = (events, tickets, texts, labels, traces, graphs, checks, runs)


def all_queries() -> dict:
    return {name: fn for module in _MODULES for name, fn in module.registry.queries.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for module in _MODULES for name, sql in module.registry.oracles.items()}
