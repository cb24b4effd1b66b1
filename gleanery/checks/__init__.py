"""Registered queries, each with the checking SQL that must give the same rows."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    """Register a query; without SQL it is checked by tests only."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def load() -> None:
    from gleanery.checks import (  # noqa: F401
        documents, pages, records, relational, scalars, store, studies, wholes,
    )
