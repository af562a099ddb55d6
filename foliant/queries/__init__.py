"""Registered queries: one Spark callable and, where SQL can express it, one
DuckDB oracle text per operator key."""

from __future__ import annotations

from importlib import import_module

_AREAS = ["tree", "planning", "catalog", "matching", "changes", "assembly"]


def _collect():
    queries, sql = {}, {}
    for area in _AREAS:
        mod = import_module(f"foliant.queries.{area}")
        for k, v in mod.QUERIES.items():
            if k in queries:
                raise KeyError(f"duplicate query key {k}")
            queries[k] = v
        sql.update(mod.SQL)
    return queries, sql


def all_queries():
    return _collect()[0]


def all_sql():
    return _collect()[1]
