"""Every operator as a runnable query on the given tables, with the same query in SQL.

A module registers queries with `@query(name, sql)`. `sql` is None where SQL cannot say it.
"""

from __future__ import annotations

import importlib

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

_MODULES = ("url_queries", "page_queries", "frontier_queries", "search_queries", "segment_queries", "robots_queries",
            "metric_queries", "crawl_queries", "stream_queries")


def query(name: str, sql: str | None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def load() -> None:
    for module in _MODULES:
        importlib.import_module(f"pagelode.registry.{module}")
