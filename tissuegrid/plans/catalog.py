"""Registry of runnable queries and, where SQL can say the same, their twin for another engine."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise KeyError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            TWINS[name] = sql
        return fn

    return register
