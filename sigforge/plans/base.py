"""Registration of queries with their SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name, with SQL for DuckDB if it can express it."""

    def add(f):
        assert f.__name__ not in QUERIES, f.__name__
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add
