"""Registered queries of this subpackage and their SQL."""
from __future__ import annotations

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f
    return add
