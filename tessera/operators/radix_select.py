"""Exact quantiles of many columns by radix select.

The bits of a double, with the sign folded in, order like its value.  Four
passes read 16 of these 64 bits each: a pass counts, per (group, column), the
digits of the values that share the digits found so far, and the running
counts say which digit holds each wanted rank.  A pass shuffles counters only,
at most 65,536 per (group, column, prefix) and task; no value leaves its
partition, no group is gathered, and all columns take the same four passes.

Quantiles are interpolated linearly between the two neighbouring ranks (numpy
``percentile``, DuckDB ``quantile_cont``).  Nulls and NaN are left out; a group
or column without values has no row (``column_quantiles``); -0.0 counts as 0.0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import import_in_workers, written

BITS = 16
TOP = np.uint64(1 << 63)
# Counters a task holds before it passes them on.
HELD = 1 << 21
MAX_GROUPS = 1 << 16


def sort_keys(values: np.ndarray) -> np.ndarray:
    """Unsigned integers that order like ``values``."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63) == 1, ~bits, bits | TOP)


def key_value(key: int) -> float:
    bits = np.uint64(key)
    return float((bits ^ TOP if bits & TOP else ~bits).view(np.float64))


class _Counters:
    """Counts per (column, prefix number, digit), merged as they come."""

    def __init__(self, n_columns: int):
        self.parts: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(n_columns)]
        self.size = 0

    def add(self, column: int, prefix: np.ndarray, digit: np.ndarray) -> None:
        codes, counts = np.unique((prefix.astype(np.int64) << BITS) | digit.astype(np.int64), return_counts=True)
        self.parts[column].append((codes, counts))
        self.size += len(codes)

    def merge(self) -> None:
        for c, parts in enumerate(self.parts):
            if len(parts) > 1:
                codes, at = np.unique(np.concatenate([x for x, _ in parts]), return_inverse=True)
                counts = np.zeros(len(codes), np.int64)
                np.add.at(counts, at, np.concatenate([n for _, n in parts]))
                self.parts[c] = [(codes, counts)]
        self.size = sum(len(x) for parts in self.parts for x, _ in parts)

    def rows(self, names) -> Iterator[pa.RecordBatch]:
        """(g, c, prefix, digit, n); ``names(column, numbers)`` gives groups and prefixes."""
        self.merge()
        for c, parts in enumerate(self.parts):
            for codes, counts in parts:
                g, prefix = names(c, codes >> BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g, pa.string()), pa.array(np.full(len(codes), c, np.int32)), pa.array(prefix, pa.int64()), pa.array((codes & 0xFFFF).astype(np.int32)), pa.array(counts.astype(np.int64))],
                    ["g", "c", "prefix", "digit", "n"],
                )
        self.parts = [[] for _ in self.parts]
        self.size = 0


def _count_digits(level: int, n_columns: int, groups: list[str], wanted: list[np.ndarray] | None):
    """The pass over batches (g, v0, v1, ...).  ``wanted`` holds per column the
    sorted (group number, prefix) codes to count; None counts all values."""
    shift = np.uint64(64 - BITS * (level + 1))

    def run(batches):
        number = {g: i for i, g in enumerate(groups)}
        counters = _Counters(n_columns)

        def names(c, at):
            if wanted is None:
                all_groups = list(number)
                return [all_groups[i] for i in at], np.zeros(len(at), np.int64)
            codes = wanted[c][at]
            return [groups[int(i)] for i in codes >> np.uint64(48)], (codes & np.uint64((1 << 48) - 1)).astype(np.int64)

        for b in batches:
            coded = b.column(0).dictionary_encode()
            here = [number.setdefault(g, len(number)) for g in coded.dictionary.to_pylist()]
            group = np.array(here, np.uint64)[coded.indices.to_numpy()] if len(b) else np.zeros(0, np.uint64)
            for c in range(n_columns):
                values = b.column(c + 1).to_numpy(zero_copy_only=False).astype(np.float64)
                held = ~np.isnan(values)
                keys, of = sort_keys(values[held]), group[held]
                if wanted is None:
                    prefix = of
                else:
                    codes = (of << np.uint64(48)) | (keys >> (shift + np.uint64(BITS)))
                    prefix = np.minimum(np.searchsorted(wanted[c], codes), max(len(wanted[c]) - 1, 0))
                    match = wanted[c][prefix] == codes if len(wanted[c]) else np.zeros(len(codes), bool)
                    keys, prefix = keys[match], prefix[match]
                if len(keys):
                    counters.add(c, prefix, (keys >> shift) & np.uint64(0xFFFF))
            if counters.size > HELD:
                counters.merge()
                if counters.size > HELD // 2:
                    yield from counters.rows(names)
        yield from counters.rows(names)

    return run


def _order_statistics(rows: DataFrame, n_columns: int, probs: list[float], max_groups: int) -> dict[tuple[str, int], list[float]]:
    """Quantiles per (group, column number) of ``rows`` (g, v0, v1, ...)."""
    spark = rows.sparkSession
    before = Window.partitionBy("g", "c", "prefix").orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("g", "c", "prefix")
    groups: list[str] = []
    # (group, column, prob, side) -> [rank left, prefix]
    at: dict[tuple[str, int, int, int], tuple[int, int]] = {}
    share: dict[tuple[str, int, int], float] = {}
    for level in range(64 // BITS):
        wanted = None
        if level:
            number = {g: i for i, g in enumerate(groups)}
            sets: list[set[int]] = [set() for _ in range(n_columns)]
            for (g, c, _, _), (_, prefix) in at.items():
                sets[c].add(number[g] << 48 | prefix)
            wanted = [np.array(sorted(s), np.uint64) for s in sets]
        counts = rows.mapInArrow(_count_digits(level, n_columns, groups, wanted), "g string, c int, prefix long, digit int, n long")
        counts = counts.groupBy("g", "c", "prefix", "digit").agg(F.sum("n").alias("n"))
        counts = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
        if level == 0:
            counts = counts.withColumn("total", F.sum("n").over(whole))
            ranks = []
            for i, p in enumerate(probs):
                h = (F.col("total") - 1) * F.lit(float(p))
                ranks += [F.struct(F.lit(i).alias("i"), F.lit(s).alias("side"), f(h).cast("long").alias("rank")) for s, f in enumerate((F.floor, F.ceil))]
            counts = counts.withColumn("ranks", F.array(*ranks))
        else:
            table: dict[tuple[str, int, int], list] = {}
            for (g, c, i, side), (rank, prefix) in at.items():
                table.setdefault((g, c, prefix), []).append((i, side, rank))
            asked = spark.createDataFrame([(*k, v) for k, v in table.items()], "g string, c int, prefix long, ranks array<struct<i:int, side:int, rank:long>>")
            counts = counts.join(F.broadcast(asked), ["g", "c", "prefix"]).withColumn("total", F.lit(0))  # groups x columns x 2 probs rows at most
        hit = F.filter("ranks", lambda r: (r["rank"] >= F.col("first")) & (r["rank"] < F.col("first") + F.col("n")))
        found = counts.select("g", "c", "prefix", "digit", "first", "total", F.explode(hit).alias("r")).select("g", "c", "prefix", "digit", "first", "total", "r.*")
        found = found.collect()
        if level == 0:
            groups = sorted({r.g for r in found})
            if len(groups) > min(max_groups, MAX_GROUPS):
                raise ValueError(f"quantiles for more than {min(max_groups, MAX_GROUPS)} groups: raise max_groups")
            for r in found:
                h = (r.total - 1) * float(probs[r.i])
                share[r.g, r.c, r.i] = h - math.floor(h)
        at = {(r.g, r.c, r.i, r.side): (r["rank"] - r["first"], r.prefix << BITS | r.digit) for r in found}
        if not at:
            return {}
    out: dict[tuple[str, int], list[float]] = {}
    for (g, c, i), part in share.items():
        low, high = (key_value(at[g, c, i, s][1]) for s in (0, 1))
        out.setdefault((g, c), [math.nan] * len(probs))[i] = low + (high - low) * part if low != high else low
    return out


def column_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], group_cols: list[str] | tuple[str, ...] = (), max_groups: int = 1024, prefix: str = "q", stored: bool = False
) -> DataFrame:
    """Group columns, ``column``, ``{prefix}0, {prefix}1, ...``: one row per
    group and column with values.  ``df`` is read four times: what is read is
    written to the checkpoint folder first, unless the caller says that it is
    ``stored`` (a table, a checkpoint)."""
    spark = df.sparkSession
    import_in_workers(spark)
    key = F.to_json(F.struct(*[F.col(f"`{g}`").alias(g) for g in group_cols])) if group_cols else F.lit("")
    rows = df.select(key.alias("g"), *[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    if not stored:
        rows = written(rows, "quantiles")
    found = _order_statistics(rows, len(cols), probs, max_groups)
    names = [f"{prefix}{i}" for i in range(len(probs))]
    out = spark.createDataFrame([(g, cols[c], *q) for (g, c), q in found.items()], ", ".join(["__g string, column string"] + [f"{n} double" for n in names]))
    if not group_cols:
        return out.drop("__g")
    schema = df.select(*[F.col(f"`{g}`").alias(g) for g in group_cols]).schema
    return out.withColumn("__g", F.from_json("__g", schema)).select(*[F.col("__g").getField(g).alias(g) for g in group_cols], "column", *names)


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float], group_cols: list[str] | tuple[str, ...] = (), max_groups: int = 1024, prefix: str = "q") -> DataFrame:
    """Quantiles of one column per group: group columns, ``{prefix}0, ...``."""
    return column_quantiles(df, [value_col], probs, group_cols, max_groups, prefix).drop("column")
