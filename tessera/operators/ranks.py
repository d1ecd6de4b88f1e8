"""Exact global ranks without a single-partition window.

``row_number() over (order by k)`` with no ``partitionBy`` moves every row to
one task.  Instead the rows are cut into ``2**bits`` buckets by the leading
bits of an md5 hex order key (buckets are monotone in the key and uniform in
size), a bucket-count table (bounded: ``2**bits`` rows per stratum) gives each
bucket its starting offset, and the rank is ``offset + row_number()`` inside
the bucket.  Exact, parallel across buckets, and skew-free because md5 keys
are uniform.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import hash_bucket
from tessera.session import cut_lineage

# Broadcast only tables whose row count is bounded by construction and below
# this many rows; anything else goes through a normal shuffle join.
BROADCAST_ROW_LIMIT = 2_000_000


def bounded_broadcast(df: DataFrame, row_bound: int, limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when its proven row bound is under ``limit``."""
    return F.broadcast(df) if row_bound <= limit else df


def bucketed_rank(
    df: DataFrame,
    order_key: Column,
    partition_cols: list[str] | tuple[str, ...] = (),
    tie_cols: list[str] | tuple[str, ...] = (),
    out: str = "rn",
    bits: int = 16,
    max_strata: int = 32,
    total_col: str | None = None,
) -> DataFrame:
    """Add ``out`` = 1-based rank of each row by ``order_key`` inside ``partition_cols``.

    ``order_key`` must be an md5 hex string (uniform leading bits).
    ``max_strata`` is the caller's bound on distinct ``partition_cols`` values; it
    bounds the offset table at ``max_strata * 2**bits`` rows.  ``total_col``
    adds the stratum's row count (from the same small table, so callers need
    no separate ``count()`` action).
    """
    parts = list(partition_cols)
    keyed = df.withColumn("__ok", order_key).withColumn("__b", hash_bucket(F.col("__ok"), bits))
    counts = keyed.groupBy(*parts, "__b").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy(*parts).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    wt = Window.partitionBy(*parts)
    offsets = counts.select(*parts, "__b", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"),
                            F.sum("__n").over(wt).alias("__tot"))
    offsets = offsets.select(*[F.col(p).alias(f"__o_{i}") for i, p in enumerate(parts)],
                             F.col("__b").alias("__ob"), "__off", "__tot")
    offsets = bounded_broadcast(offsets, max_strata * (1 << bits))
    # Null-safe on the strata so a NULL class is its own stratum.
    cond = F.col("__b") == F.col("__ob")
    for i, p in enumerate(parts):
        cond = cond & F.col(p).eqNullSafe(F.col(f"__o_{i}"))
    joined = keyed.join(offsets, on=cond, how="inner").drop("__ob", *[f"__o_{i}" for i in range(len(parts))])
    wb = Window.partitionBy(*parts, "__b").orderBy("__ok", *tie_cols)
    res = joined.withColumn(out, (F.col("__off") + F.row_number().over(wb)).cast("long"))
    if total_col:
        res = res.withColumn(total_col, F.col("__tot").cast("long"))
    return res.drop("__b", "__off", "__ok", "__tot")


def hash_cuts(df: DataFrame, order_key: Column, id_col: str, ranks, few: int = 10_000) -> tuple[int, list[tuple[str, str] | None]]:
    """(rows, cuts): for each rank of ``ranks(rows)`` the (key, id as string)
    of the row with that 1-based rank by (``order_key``, id); None for rank 0.

    Membership by rank then is a comparison in the scan, and no row moves.
    ``order_key`` is an md5 hex string.  The first job counts rows by the four
    leading digits (65,536 counters); only buckets that hold a cut are cut
    further, four digits at a time, until one has at most ``few`` rows, which
    are sorted.  Equal keys are equal ids (the key is a hash of the id)."""
    keyed = df.select(order_key.alias("k"), F.col(f"`{id_col}`").cast("string").alias("i"))

    def counts(rows: DataFrame, width: int) -> dict[str, int]:
        return {r["p"]: r["n"] for r in rows.groupBy(F.substring("k", 1, width).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}

    found = counts(keyed, 4)
    total = sum(found.values())
    left = {r: ("", r) for r in ranks(total)}  # rank: bucket, rank within
    levels, done = {"": found}, {}
    for width in range(4, 33, 4):
        for r, (bucket, rest) in list(left.items()):
            for p, n in sorted(levels[bucket].items()):
                if rest <= n:
                    left[r] = (p, rest)
                    break
                rest -= n
            if r < 1:
                done[r] = left.pop(r) and None
            elif n <= few or width == 32:
                done[r] = left.pop(r)
        if not left:
            break
        deeper = {p for p, _ in left.values()}
        levels = {p: {} for p in deeper}
        inside = counts(keyed.where(F.substring("k", 1, width).isin(*deeper)), width + 4)
        for p, n in inside.items():
            levels[p[:width]][p] = n
    cuts: dict[int, tuple[str, str] | None] = {}
    buckets = {at[0] for at in done.values() if at}
    rows: dict[str, list[tuple[str, str]]] = {p: [] for p in buckets}
    for width in {len(p) for p in buckets if len(p) < 32}:
        own = [p for p in buckets if len(p) == width]
        for r in keyed.where(F.substring("k", 1, width).isin(*own)).collect():  # at most ``few`` a cut
            rows[r.k[:width]].append((r.k, r.i))
    for r, at in done.items():
        if at is None:
            cuts[r] = None
        elif len(at[0]) == 32:  # one key in more rows than ``few``: equal ids
            cuts[r] = (at[0], keyed.where(F.col("k") == at[0]).agg(F.max("i")).first()[0])
        else:
            cuts[r] = sorted(rows[at[0]], key=lambda x: (x[0], x[1] or ""))[at[1] - 1]
    return total, [cuts[r] for r in ranks(total)]


def _ranged(df: DataFrame, *order: str) -> DataFrame:
    """Rows cut into ranges of ``order``, with the range number ``__bk``.

    Spark samples the cut points, so ranges are even whatever the key: a key
    of a third of the rows takes a third of the ranges.  The result is stored
    (reliable checkpoint): range numbers must not change between the count of
    the ranges and their use, also when an executor is lost."""
    return cut_lineage(df.repartitionByRange(*[F.col(c) for c in order]).withColumn("__bk", F.spark_partition_id()))


def rank_within_key(df: DataFrame, key: str, order: str | list[str], out: str = "rn") -> DataFrame:
    """1-based occurrence number of each row inside ``key`` by ``order`` (one
    column or several, together unique within the key), without sending a hot key, or the null key, to
    one task: the rank is the rows of the key in earlier ranges plus
    ``row_number`` inside (key, range)."""
    order = [order] if isinstance(order, str) else list(order)
    keyed = _ranged(df, key, *order)
    counts = keyed.groupBy(key, "__bk").agg(F.count(F.lit(1)).alias("__n"))
    # a key has as many rows here as it has ranges
    w = Window.partitionBy(key).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(key).alias("__rk"), F.col("__bk").alias("__rob"),
                            F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__roff"))
    cond = F.col(key).eqNullSafe(F.col("__rk")) & (F.col("__bk") == F.col("__rob"))
    joined = keyed.join(offsets, on=cond, how="inner").drop("__rk", "__rob")
    wb = Window.partitionBy(key, "__bk").orderBy(*order)
    return joined.withColumn(out, (F.col("__roff") + F.row_number().over(wb)).cast("long")).drop("__bk", "__roff")


def running_sum(
    df: DataFrame,
    partition_col: str,
    order_col: str,
    value_cols: list[str],
    suffix: str = "_before",
) -> DataFrame:
    """For each row, the sum of ``value_cols`` over rows of the same
    ``partition_col`` with a strictly smaller ``order_col`` (unique within the
    partition, e.g. distinct values or scores).

    A window ordered over a whole partition would sort every distinct value of
    a descriptor in one task.  Here totals per (partition, range) give
    offsets, and the running window only spans one (partition, range); ``df``
    is computed once.
    """
    keyed = _ranged(df, partition_col, order_col)
    totals = keyed.groupBy(partition_col, "__bk").agg(*[F.sum(c).alias(f"__t_{c}") for c in value_cols])
    wo = Window.partitionBy(partition_col).orderBy("__bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(partition_col).alias("__op"), F.col("__bk").alias("__ob"),
        *[F.coalesce(F.sum(f"__t_{c}").over(wo), F.lit(0)).alias(f"__o_{c}") for c in value_cols])
    j = keyed.join(offsets, (F.col(partition_col).eqNullSafe(F.col("__op"))) & (F.col("__bk") == F.col("__ob")),
                   "inner").drop("__op", "__ob")
    wi = Window.partitionBy(partition_col, "__bk").orderBy(order_col).rowsBetween(Window.unboundedPreceding, -1)
    for c in value_cols:
        j = j.withColumn(f"{c}{suffix}", F.col(f"__o_{c}") + F.coalesce(F.sum(c).over(wi), F.lit(0)))
    return j.drop("__bk", *[f"__o_{c}" for c in value_cols])
