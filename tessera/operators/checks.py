"""Checks that stop a run, or choose how to go on (P17, P21, P26, D6, T10,
T13, T15, J7).

Each check is one or two aggregates over the table; what reaches the driver
is counts and a preview of at most ten ids.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import whole_number
from tessera.functions.scalar import is_finite
from tessera.operators.ranks import rank_within_key
from tessera.sources.tables import ROW_INDEX

PREVIEW = 10
PARTS = ("train", "val", "test")


def _preview(ids: DataFrame, col: str) -> list:
    return [r[0] for r in ids.select(col).orderBy(col).limit(PREVIEW).collect()]


def finite_rows(df: DataFrame, cols: list[str], mode: str = "drop") -> DataFrame:
    """Rows whose ``cols`` are all finite numbers.  ``drop`` removes the
    others, ``fail`` raises with their number, ``keep`` leaves them (infinite
    cells become null in any mode)."""
    clean = df.withColumns({c: F.when(is_finite(c), F.col(f"`{c}`").cast("double")) for c in cols})
    whole = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in cols])
    if mode == "keep":
        return clean
    if mode == "fail":
        bad = clean.agg(F.count_if(~whole)).first()[0]
        if bad:
            raise ValueError(f"{bad} rows have a missing or infinite value in {cols}")
        return clean
    return clean.filter(whole)


def distinct_feature_rows(df: DataFrame, value_cols: list[str], order: str = ROW_INDEX, mode: str = "drop") -> DataFrame:
    """Rows equal on ``value_cols`` (features and label, nulls equal).
    ``drop`` keeps the first by ``order`` of each, whole; ``fail`` raises with
    the number of further copies; ``keep`` returns all rows."""
    if mode == "keep":
        return df
    values = [F.col(f"`{c}`") for c in value_cols]
    if mode == "fail":
        copies = df.groupBy(*values).agg(F.count(F.lit(1)).alias("n")).agg(F.sum(F.col("n") - 1)).first()[0]
        if copies:
            raise ValueError(f"{copies} rows repeat the values of another row")
        return df
    rest = [c for c in df.columns if c not in value_cols]
    first = df.groupBy(*values).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in rest]), F.col(f"`{order}`")).alias("__first"))
    return first.select(*[F.col("__first")[c].alias(c) if c in rest else F.col(f"`{c}`") for c in df.columns])


def valid_row_index(df: DataFrame, col: str = ROW_INDEX) -> DataFrame:
    """The table with ``col`` as long, or an error that says what is
    wrong: absent, null, not an integer, or repeated (count and ten ids)."""
    if col not in df.columns:
        raise ValueError(f"no row index column {col!r}")
    number = whole_number(F.col(f"`{col}`"))
    seen = df.agg(
        F.count_if(F.col(f"`{col}`").isNull()).alias("null"),
        F.count_if(F.col(f"`{col}`").isNotNull() & number.isNull()).alias("odd"),
    ).first()
    if seen["null"] or seen["odd"]:
        raise ValueError(f"row index {col!r}: {seen['null']} nulls, {seen['odd']} values that are not integers")
    out = df.withColumn(col, number)
    repeated = out.groupBy(col).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    ids = _preview(repeated, col)
    if ids:
        raise ValueError(f"row index {col!r}: {repeated.count()} ids occur more than once, such as {ids}")
    return out


def numeric_features(df: DataFrame, target: str | None = None) -> DataFrame:
    """All columns but ``target`` as doubles, or an error that names the
    columns with cells that are no numbers (or says that none is left)."""
    features = [c for c in df.columns if c != target]
    if not features:
        raise ValueError("no feature column is left beside the target")
    number = {c: F.col(f"`{c}`").cast("string").try_cast("double") for c in features}
    bad = df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & number[c].isNull()).alias(c) for c in features]).first().asDict()
    bad = {c: n for c, n in bad.items() if n}
    if bad:
        raise ValueError(f"cells that are no numbers, by column: {bad}")
    return df.select(*[number[c].alias(c) if c in number else F.col(f"`{c}`") for c in df.columns])


def checked_fold(folds: DataFrame, repeat: int, fold: int, id_col: str = ROW_INDEX) -> DataFrame:
    """The fold as test and the rest of its repeat as train; an error
    when the plan has no such repeat or fold."""
    top = folds.agg(F.max("repeat").alias("r"), F.max("fold").alias("f")).first()
    if top["r"] is None or not (0 <= repeat <= top["r"] and 0 <= fold <= top["f"]):
        raise ValueError(f"no fold {fold} in repeat {repeat}: the plan has repeats 0..{top['r']} and folds 0..{top['f']}")
    part = F.when(F.col("fold") == fold, F.lit("test")).otherwise(F.lit("train"))
    return folds.filter(F.col("repeat") == repeat).select(id_col, part.alias("split"))


def checked_split(splits: DataFrame, universe: DataFrame, id_col: str = ROW_INDEX, min_coverage: float | None = None,
                  disjoint: bool = True, val_expected: bool = True) -> DataFrame:
    """``splits`` (id, split) unchanged, or an error: ids outside the
    universe, coverage under ``min_coverage``, ids in two parts (a warning
    when not ``disjoint``), or an empty part."""
    ids = splits.groupBy(id_col).agg(F.count_distinct("split").alias("parts"))
    known = universe.select(F.col(id_col).alias("__known")).distinct()
    joined = ids.join(known, F.col(id_col) == F.col("__known"), "full")
    seen = joined.agg(
        F.count(id_col).alias("used"),
        F.count("__known").alias("universe"),
        F.count_if(F.col(id_col).isNotNull() & F.col("__known").isNull()).alias("unknown"),
        F.count_if(F.col("parts") > 1).alias("shared"),
    ).first()
    sizes = {r["split"]: r["n"] for r in splits.where(F.col("split").isin(*PARTS)).groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    if seen["unknown"]:
        outside = joined.where(F.col(id_col).isNotNull() & F.col("__known").isNull())
        raise ValueError(f"{seen['unknown']} split ids are not in the table, such as {_preview(outside, id_col)}")
    if min_coverage is not None and seen["used"] < min_coverage * max(1, seen["universe"]):
        raise ValueError(f"the split covers {seen['used']} of {seen['universe']} rows, under {min_coverage}")
    if seen["shared"]:
        if disjoint:
            raise ValueError(f"{seen['shared']} ids are in more than one part")
        warnings.warn(f"{seen['shared']} ids are in more than one part", stacklevel=2)
    for part in ("train", "test", *(("val",) if val_expected else ())):
        if not sizes.get(part):
            raise ValueError(f"part {part!r} is empty")
    return splits


def resolved_partitions(splits: DataFrame, rows: DataFrame, id_col: str = ROW_INDEX, min_coverage: dict[str, float] | None = None) -> DataFrame:
    """The split of the rows that are left after cleaning.  A validation
    part without a test part serves as test.  ``min_coverage`` sets, by part,
    the least share of its ids that must be left (test: 1.0 asks for all)."""
    left = rows.select(F.col(id_col).alias("__left")).distinct()
    joined = splits.join(left, F.col(id_col) == F.col("__left"), "left")
    counts = joined.groupBy("split").agg(F.count(F.lit(1)).alias("n"), F.count("__left").alias("left")).where(F.col("split").isin(*PARTS))
    seen = {r["split"]: (r["n"], r["left"]) for r in counts.collect()}
    swap = "test" not in seen and "val" in seen
    if swap:
        seen["test"] = seen.pop("val")
    for part, least in (min_coverage or {}).items():
        n, have = seen.get(part, (0, 0))
        if n and have + 1e-12 * n < least * n:
            raise ValueError(f"{part}: {have} of {n} ids are left after cleaning, under the share {least}")
    if not seen.get("train", (0, 0))[1] or not seen.get("test", (0, 0))[1]:
        raise ValueError(f"train or test is empty after cleaning; ids before and after, by part: {seen}")
    part = F.when(F.col("split") == "val", F.lit("test")).otherwise(F.col("split")) if swap else F.col("split")
    return joined.where(F.col("__left").isNotNull()).select(id_col, part.alias("split"))


def split_positions(splits: DataFrame, rows: DataFrame, id_col: str = ROW_INDEX, order: str | list[str] = ROW_INDEX,
                    positions_allowed: bool = False) -> DataFrame:
    """(position, split) of split ids, a position being the row's rank by
    ``order`` from 0.  Ids must be unique in ``rows`` and all be found there;
    with ``positions_allowed``, ids that are not but lie in 0..n-1 are taken
    for positions themselves (a split of an older kind).  A validation part
    without a test part serves as test."""
    ranked = rank_within_key(valid_row_index(rows, id_col).withColumn("__all", F.lit(0)), "__all", order, out="__rank")
    at = ranked.select(F.col(id_col).cast("long").alias("__id"), (F.col("__rank") - 1).alias("__at"))
    joined = splits.select(F.col(id_col).cast("long").alias("__want"), "split").join(at, F.col("__want") == F.col("__id"), "left")
    n = rows.count()
    seen = joined.agg(
        F.count_if(F.col("__at").isNull()).alias("lost"),
        F.count_if((F.col("__want") < 0) | (F.col("__want") >= n)).alias("outside"),
        F.count_if(F.col("split") == "test").alias("test"),
    ).first()
    position = F.col("__at")
    if seen["lost"]:
        like_positions = seen["outside"] == 0
        if not (like_positions and positions_allowed):
            hint = "; they look like positions (positions_allowed)" if like_positions else ""
            raise ValueError(f"{seen['lost']} split ids are not in {id_col!r}, such as {_preview(joined.where('__at is null'), '__want')}{hint}")
        position = F.col("__want")
    part = F.when(F.col("split") == "val", F.lit("test")).otherwise(F.col("split")) if not seen["test"] else F.col("split")
    return joined.select(position.alias("position"), part.alias("split"))
