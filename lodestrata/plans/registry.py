"""The registered queries and the SQL that they equal."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name, with DuckDB's SQL of the same rows."""

    def register(f):
        if f.__name__ in QUERIES:
            raise ValueError(f"two queries named {f.__name__}")
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register
