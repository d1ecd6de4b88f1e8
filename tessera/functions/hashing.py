"""Deterministic hash orders.

Row order that the reference takes from a seeded RNG is replaced by the order
of ``md5(seed ':' id)``.  The same expression exists in DuckDB, so split
membership can be checked exactly by an SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296.0


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(seed, *cols) -> Column:
    """md5 hex of ``seed:c1:c2...`` (32 lowercase hex chars)."""
    parts = [F.lit(str(seed))] + [_as_col(c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_unit(seed, *cols) -> Column:
    """Uniform double in [0, 1) from the first 32 bits of ``hash_key``."""
    return F.conv(F.substring(hash_key(seed, *cols), 1, 8), 16, 10).cast("double") / F.lit(TWO_32)


def hash_bucket(key: Column, bits: int = 16) -> Column:
    """Leading ``bits`` bits of an md5 hex key as an int (monotone in the key)."""
    n_hex = max(1, bits // 4)
    return F.conv(F.substring(key, 1, n_hex), 16, 10).cast("int")


def hex_to_long(hex_col: Column, n_chars: int = 8) -> Column:
    return F.conv(F.substring(hex_col, 1, n_chars), 16, 10).cast("long")
