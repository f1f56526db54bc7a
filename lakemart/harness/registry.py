"""Registry of harness queries: ``name -> (spark, sf_dir) -> DataFrame`` and
``name -> DuckDB SQL`` (absent for checks that SQL cannot express)."""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}

_MODULES = ["sources", "schema", "filters", "relational", "exam", "games", "quality"]


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"lakemart.harness.q_{m}")
