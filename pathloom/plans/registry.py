"""Named queries and the SQL that DuckDB checks them with."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function of (spark, sf_dir); ``sql`` is its equivalent in DuckDB."""

    def put(f: Callable) -> Callable:
        key = name or f.__name__
        if key in QUERIES:
            raise ValueError(f"two queries are named {key}")
        QUERIES[key] = f
        if sql is not None:
            ORACLES[key] = sql
        return f

    return put
