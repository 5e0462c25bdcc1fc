"""Named queries with their SQL."""

from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function (spark, sf_dir) and, if SQL can express it, DuckDB SQL for its rows."""

    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return keep
