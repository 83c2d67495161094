"""Registered queries: a Spark plan and, where SQL can say the same, a DuckDB
oracle over the same parquet tables (column names equal on both sides)."""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}
TAGS: dict[str, str] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        TAGS[name] = ids
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> tuple[dict[str, Callable], dict[str, str]]:
    from trellis.plans import graph_queries, io_queries, path_queries, search_queries, usage_queries  # noqa: F401
    return QUERIES, ORACLE
