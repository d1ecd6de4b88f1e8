"""Joins and row alignment (J1-J7, J14, J15) and set operations.

Every alignment is an equi-join on the row id; guards (missing ids, count
mismatches) are anti-joins reduced to a count, with at most a 10-row preview
(O3) ever reaching the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.ranks import rank_within_key
from tessera.sources.tables import ROW_INDEX


def align_features_labels(X: DataFrame, y: DataFrame, target: str, id_col: str = ROW_INDEX,
                          check_counts: bool = True) -> DataFrame:
    """Y re-ordered to X by id (left join); target removed from X first."""
    if target in X.columns:
        X = X.drop(target)
    if check_counts:
        nx, ny = X.count(), y.count()
        if nx != ny:
            raise ValueError(f"features and labels differ in row count: {nx} vs {ny}")
    return X.join(y.select(id_col, target), on=id_col, how="left")


def missing_ids(ids: DataFrame, table_: DataFrame, id_col: str = ROW_INDEX) -> DataFrame:
    """J2/J3 guard: requested ids absent from ``table_``."""
    return ids.select(id_col).distinct().join(table_.select(id_col), on=id_col, how="left_anti")


def restrict_to_ids(table_: DataFrame, ids: DataFrame, id_col: str = ROW_INDEX, strict: bool = False) -> DataFrame:
    """Rows of ``table_`` whose id is requested (left semi join)."""
    if strict:
        preview = [r[0] for r in missing_ids(ids, table_, id_col).orderBy(id_col).limit(10).collect()]
        if preview:
            n = missing_ids(ids, table_, id_col).count()
            raise ValueError(f"{n} requested ids are missing, e.g. {preview}")
    return table_.join(ids.select(id_col).distinct(), on=id_col, how="left_semi")


def row_overlap(train: DataFrame, test: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Test rows equal to some train row on all common columns, missing
    equals missing (null-safe semi join)."""
    cols = cols or [c for c in train.columns if c in test.columns]
    t = train.select(*[F.col(c).alias(f"__tr_{i}") for i, c in enumerate(cols)]).distinct()
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__tr_{i}")) for i, c in enumerate(cols)])
    return test.join(t, on=cond, how="left_semi")


def nth_occurrence_join(left: DataFrame, right: DataFrame, key: str, left_order: str | list[str],
                        right_order: str | list[str],
                        how: str = "left") -> DataFrame:
    """The k-th copy of a key on the left matches the k-th on the right.
    Occurrence numbers come from the skew-safe ``rank_within_key``."""
    lr = rank_within_key(left, key, left_order, out="__occ")
    rr = rank_within_key(right, key, right_order, out="__occ")
    rr = rr.select(*[F.col(c).alias(f"r_{c}") if c not in (key, "__occ") else F.col(c) for c in rr.columns])
    return lr.join(rr, on=[key, "__occ"], how=how)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Concat, columns aligned by name, missing ones NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
