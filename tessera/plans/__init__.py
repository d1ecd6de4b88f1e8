"""Query registry: each entry is ``fn(spark, sf_dir) -> DataFrame`` plus, where
the operator is SQL-expressible, the DuckDB oracle SQL with identical column
names.  Doubles are ``round(x, 6)`` on both sides.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

_MODULES = (
    "flagship",
    "curation",
    "dedupe",
    "joins",
    "splits",
    "preprocess",
    "stats",
    "eda",
    "metrics",
    "runs",
    "grid",
    "features",
    "models",
    "scalars",
    "io",
    "streams",
)


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    for mod in _MODULES:
        importlib.import_module(f"tessera.plans.{mod}")
