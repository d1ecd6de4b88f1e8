"""Operators for large training-corpus preparation, and their queries.

Nothing outside this folder imports it; ``__spark_entry__`` adds the queries
when the folder is present.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

_MODULES = (
    "token_counts",
    "license_scan",
    "word_shuffle_bpe",
    "radix_dedup",
    "host_quality",
    "substring_dedup",
    "warc",
    "ngram_join",
    "token_store",
    "packing",
    "line_dedup",
    "centroids",
    "lexical_search",

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
        importlib.import_module(f"tessera.llm.{mod}")
