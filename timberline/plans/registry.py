"""Registration of queries with their SQL oracles."""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def with_logs(sql: str, *before: str) -> str:
    """SQL over the log records, with further common table expressions."""
    from timberline.sources.tables import LOGS_SQL

    return "WITH " + ",\n".join([LOGS_SQL.strip(), *before]) + "\n" + sql
