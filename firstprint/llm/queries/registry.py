"""The queries of this subpackage, and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where SQL can express it."""
    def keep(build):
        QUERIES[name] = build
        if sql:
            ORACLES[name] = sql
        return build
    return keep

