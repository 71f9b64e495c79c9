"""Named queries and their SQL oracles.

A query is ``fn(spark, sf_dir) -> DataFrame``; its oracle is a plain SQL
string over the same tables (standard SQL as DuckDB runs it), so every
result can be checked row by row against a second engine."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

_MODULES = ["q_sources", "q_relational", "q_aggregate", "q_functions", "q_warehouse", "q_history", "q_loads"]


def query(key: str, sql: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise KeyError(f"duplicate query {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def load() -> tuple[dict[str, Callable], dict[str, str]]:
    for m in _MODULES:
        importlib.import_module(f"starloom.plans.{m}")
    return dict(QUERIES), dict(ORACLE)
