"""Curation: projections, filters, labels, row identity.

Filter order is semantic (filters run before keep-first dedupe and change the
winner), so callers chain these in the written order; Catalyst still pushes
each predicate into the parquet scan when the plan allows it.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import whole_number
from tessera.operators.ranks import rank_within_key
from tessera.session import ensure_checkpoint_dir, written
from tessera.functions.scalar import binary01, is_finite, token
from tessera.sources.tables import ROW_INDEX

# Fixed values that must equal the reference's behaviour.
KEY_ALIASES = ["canonical_smiles", "smiles", "SMILES", "Smiles", "Drug", "drug"]
ID_ALIASES = ["molecule_chembl_id", "mol_id", "compound_id", "id", "ID"]
CLASS_ORDER = ["active", "intermediate", "inactive"]
VALUE_CAP = 1e8


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def not_missing(c) -> Column:
    """pandas ``notna``: not NULL and (for floating columns) not NaN."""
    col = _q(c) if isinstance(c, str) else c
    return col.isNotNull() & F.coalesce(~F.isnan(col.try_cast("double")), F.lit(True))


def resolve_key(columns: list[str], candidates: list[str] | None = None) -> str:
    """First present key alias."""
    for c in candidates or KEY_ALIASES:
        if c and c in columns:
            return c
    raise ValueError("Could not find a key column. Tried: " + ", ".join(candidates or KEY_ALIASES))


def resolve_target(columns: list[str], name: str) -> str | None:
    """Case-insensitive target lookup."""
    if name in columns:
        return name
    low = {c.lower(): c for c in columns}
    return low.get(str(name).lower())


def drop_missing_key(df: DataFrame, key: str) -> DataFrame:
    """P1."""
    return df.filter(_q(key).isNotNull())


def rename_key(df: DataFrame, key: str, to: str = "canonical_smiles") -> DataFrame:
    """P2."""
    return df if key == to else df.withColumnRenamed(key, to)


def drop_missing_target(df: DataFrame, target: str | None) -> DataFrame:
    """Only when the column exists."""
    if not target or target not in df.columns:
        return df
    return df.filter(not_missing(target))


def require_non_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows missing any of ``cols``; unknown column -> error."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns that must not be null are absent: {sorted(missing)}")
    if not cols:
        return df
    return df.filter(reduce(lambda a, b: a & b, [not_missing(c) for c in cols]))


def row_filters(df: DataFrame, filters: dict | None) -> DataFrame:
    """P5: conjunction of ``col IN (values)``; one value stands for a list of
    it, blank names are skipped.  Literals are cast to the column's type (ANSI
    would raise on a bad implicit cast, pandas says false)."""
    for name, allowed in (filters or {}).items():
        column = str(name).strip()
        if column == "":
            continue
        field = next((f for f in df.schema.fields if f.name == column), None)
        if field is None:
            raise ValueError(f"cannot filter on {column!r}: no such column")
        several = allowed if isinstance(allowed, (list, tuple, set)) else (allowed,)
        if len(several) == 0:
            raise ValueError(f"the filter on {column!r} allows no value")
        df = df.filter(_q(column).isin(*[F.lit(v).try_cast(field.dataType) for v in several]))
    return df


def select_columns(df: DataFrame, key: str, properties: list[str] | None = None, label: str | None = None,
                   keep_all: bool = False) -> DataFrame:
    """Id + row index + key + present properties + label, in that order."""
    if keep_all:
        return df
    chosen: list[str] = []
    id_col = next((c for c in ID_ALIASES if c in df.columns), None)
    for c in [id_col, ROW_INDEX if ROW_INDEX in df.columns else None, key,
              *[p for p in (properties or []) if p in df.columns],
              label if label and label in df.columns else None]:
        if c and c not in chosen:
            chosen.append(c)
    return df.select(*[_q(c) for c in chosen])


def class_bucket(value: Column, active: float = 1000.0, inactive: float = 10000.0) -> Column:
    """<= active -> active, > inactive -> inactive, else intermediate."""
    return (
        F.when(value <= F.lit(active), F.lit("active"))
        .when(value > F.lit(inactive), F.lit("inactive"))
        .otherwise(F.lit("intermediate"))
    )


def label_classes(df: DataFrame, value_col: str, active: float = 1000.0, inactive: float = 10000.0,
                  out: str = "class") -> DataFrame:
    """Drop rows with a missing value, then bucket."""
    if value_col not in df.columns:
        return df
    return df.filter(not_missing(value_col)).withColumn(out, class_bucket(_q(value_col), active, inactive))


def neg_log10_nano(value: Column) -> Column:
    """``-log10(min(v, 1e8) * 1e-9)``; NULL/NaN stay NULL.  As NumPy's
    logarithm has it, 0 gives +inf and a negative value NaN (Spark's log10
    would give NULL for both)."""
    v = value.cast("double")
    capped = F.when(F.isnan(v), F.lit(None)).when(v > F.lit(VALUE_CAP), F.lit(VALUE_CAP)).otherwise(v)
    return F.when(capped == 0, F.lit(float("inf"))).when(capped < 0, F.lit(float("nan"))).otherwise(-F.log10(capped * F.lit(1e-9)))


def two_class_subset(df: DataFrame, class_col: str = "class", p_col: str = "pIC50") -> DataFrame:
    """P10: drop the intermediate class and non-finite p."""
    return df.filter((F.col(class_col) != "intermediate") & is_finite(p_col))


def normalize_binary_labels(df: DataFrame, source: str, target: str, positive: list[str], negative: list[str],
                            drop_unmapped: bool = True) -> DataFrame:
    """Numeric 0/1 first, then positive / negative tokens."""
    tok = token(source)
    pos = [p.lower() for p in positive]
    neg = [n.lower() for n in negative]
    mapped = F.coalesce(
        binary01(_q(source)),
        F.when(tok.isin(*pos), F.lit(1)).when(tok.isin(*neg), F.lit(0)),
    )
    out = df.withColumn(target, mapped)
    return out.filter(F.col(target).isNotNull()) if drop_unmapped else out


def strict_binary(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """The non-null values are either exactly the words active and
    inactive, or all numbers 0 / 1; anything else (a mixture, one of the words
    alone, a third value) is an error.  One aggregate decides for the table."""
    out = out or col
    tok, number, value = token(col), binary01(_q(col)), _q(col)
    seen = df.agg(
        F.count(value).alias("n"),
        F.count_distinct(value).alias("values"),
        F.count(number).alias("numbers"),
        F.count_if(tok == "active").alias("active"),
        F.count_if(tok == "inactive").alias("inactive"),
    ).first()
    if seen["values"] <= 2 and seen["numbers"] == seen["n"]:
        return df.withColumn(out, number)
    if seen["active"] and seen["inactive"] and seen["active"] + seen["inactive"] == seen["n"]:
        return df.withColumn(out, F.when(tok == "active", F.lit(1)).when(tok == "inactive", F.lit(0)))
    raise ValueError(f"column {col!r} is not a binary label: {seen['values']} distinct values, {seen['numbers']} of {seen['n']} cells are 0 or 1")


def exclude_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop configured names; absent names ignored."""
    seen: list[str] = []
    for c in cols:
        if c not in seen:
            seen.append(c)
    return df.drop(*[c for c in seen if c in df.columns])


def drop_key_columns(df: DataFrame) -> DataFrame:
    """Drop smiles / canonical_smiles in any case."""
    return df.drop(*[c for c in df.columns if c.lower() in ("smiles", "canonical_smiles")])


def numeric_coerce(df: DataFrame, cols: list[str]) -> DataFrame:
    """Cells that do not parse become NULL; columns that end up all
    missing are dropped (one aggregate decides)."""
    coerced = df.select(*[(_q(c).cast("string").try_cast("double") if c in cols else _q(c)).alias(c)
                          for c in df.columns])
    counts = coerced.agg(*[F.count(_q(c)).alias(c) for c in cols]).first().asDict()
    return coerced.drop(*[c for c in cols if counts[c] == 0])


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """+-inf -> missing; drop rows with any missing in ``cols``."""
    cleaned = df
    for c in cols:
        cleaned = cleaned.withColumn(c, F.when(is_finite(c), _q(c).cast("double")))
    return cleaned.na.drop(subset=cols)


def one_hot(df: DataFrame, cols: list[str], max_categories: int = 1000) -> DataFrame:
    """Null -> 'missing'; one 0/1 column per sorted value, named
    ``col_value``, appended at the end.  A column with more than
    ``max_categories`` values is refused (``one_hot_sparse`` takes any number)."""
    out = df
    for c in cols:
        filled = F.coalesce(_q(c).cast("string"), F.lit("missing"))
        cats = sorted(r[0] for r in df.select(filled.alias("v")).distinct().limit(max_categories + 1).collect())
        if len(cats) > max_categories:
            raise ValueError(f"column {c!r} has more than {max_categories} values: use one_hot_sparse")
        out = out.select(*[_q(x) for x in out.columns if x != c],
                         *[(filled == F.lit(v)).cast("int").alias(f"{c}_{v}") for v in cats])
    return out


def one_hot_sparse(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """P18 at any cardinality: (rows, dictionary).  ``dictionary`` (value,
    position) numbers the values (null is 'missing') in sorted order from 0, by
    ranges, so neither the driver nor a task holds them all; ``rows`` is ``df``
    with ``col`` replaced by the sparse vector struct (size, indices, values)."""
    filled = F.coalesce(_q(col).cast("string"), F.lit("missing"))
    values = df.select(filled.alias("value")).distinct().withColumn("__all", F.lit(0))
    dictionary = rank_within_key(values, "__all", "value", out="position").select("value", (F.col("position") - 1).alias("position"))
    dictionary = written(dictionary, "dictionary")
    size = dictionary.count()
    vector = F.struct(F.lit(size).cast("long").alias("size"), F.array("__position").alias("indices"), F.array(F.lit(1.0)).alias("values"))
    found = df.withColumn("__value", filled).join(dictionary.select(F.col("value").alias("__value"), F.col("position").alias("__position")), "__value")
    return found.select(*[vector.alias(c) if c == col else _q(c) for c in df.columns]), dictionary


def clip(c, lo: float = -1e10, hi: float = 1e10) -> Column:
    """Clip to [lo, hi]; NULL and NaN pass through."""
    col = _q(c) if isinstance(c, str) else c
    return F.when(col.isNull() | F.isnan(col), col).otherwise(F.least(F.greatest(col, F.lit(lo)), F.lit(hi)))


def assign_row_index(df: DataFrame, natural_key: Column | None = None, stored: bool = False) -> DataFrame:
    """P20: natural key when the table has one; otherwise a dense position
    0..n-1 in scan order.  Two passes: rows per partition, then the rows of
    earlier partitions plus the position within, all in the JVM.  Both passes
    must see the same partitions, so ``df`` is checkpointed, unless it is the
    plain scan of a ``stored`` table."""
    if ROW_INDEX in df.columns:
        return df
    if natural_key is not None:
        return df.withColumn(ROW_INDEX, natural_key.cast("long"))
    if not stored:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    sizes = {r["p"]: r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per partition
    before, offsets = 0, []
    for p in range(max(sizes, default=-1) + 1):
        offsets.append(before)
        before += sizes.get(p, 0)
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start = F.get(F.lit(offsets).cast("array<long>"), F.spark_partition_id()) if offsets else F.lit(0)
    return df.withColumn(ROW_INDEX, (start + within).cast("long"))


def row_index_report(df: DataFrame, col: str = ROW_INDEX) -> DataFrame:
    """One-row report: rows, NULL ids, non-integer ids, duplicate ids."""
    per_id = df.groupBy(_q(col).alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    dups = per_id.agg(
        F.coalesce(F.sum(F.when((F.col("__n") > 1) & F.col("__id").isNotNull(), F.col("__n"))), F.lit(0)).cast("long").alias("duplicate_rows"),
        F.count_if((F.col("__n") > 1) & F.col("__id").isNotNull()).cast("long").alias("duplicate_ids"),
    )
    base = df.agg(
        F.count(F.lit(1)).cast("long").alias("n_rows"),
        F.count_if(_q(col).isNull()).cast("long").alias("null_ids"),
        F.count_if(_q(col).isNotNull() & whole_number(_q(col)).isNull()).cast("long").alias("non_integer_ids"),
    )
    # Both sides are one-row aggregates.
    return base.join(dups, how="inner")


def rule_flags(df: DataFrame, rules: dict[str, Column], min_pass: int | None = None) -> DataFrame:
    """One boolean column per rule, the pass count, and the verdict
    (all rules, or at least ``min_pass``)."""
    out = df
    for name, pred in rules.items():
        out = out.withColumn(name, F.coalesce(pred, F.lit(False)))
    n = reduce(lambda a, b: a + b, [F.col(n).cast("int") for n in rules])
    out = out.withColumn("n_pass", n)
    need = len(rules) if min_pass is None else min_pass
    return out.withColumn("passes", F.col("n_pass") >= F.lit(need))


def band(value: Column, edges: list[float], labels: list[str]) -> Column:
    """Right-closed bins ``(e_i, e_{i+1}]`` -> label; outside -> NULL."""
    expr = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (value > F.lit(lo)) & (value <= F.lit(hi))
        expr = F.when(cond, F.lit(lab)) if expr is None else expr.when(cond, F.lit(lab))
    return expr


def sanitize_feature_names(columns: list[str]) -> list[tuple[str, str]]:
    """P25: '[', ']', '<', '>' -> '_'; empty -> 'feature'; collisions get
    ``__2``, ``__3`` ...  Returns (original, sanitized) pairs.  Schema-only."""
    plain = {ord(ch): "_" for ch in "[]<>"}
    taken: dict[str, str] = {}  # sanitized -> original position, in order
    for position, column in enumerate(columns):
        stem = str(column).translate(plain) or "feature"
        candidates = itertools.chain([stem], (f"{stem}__{k}" for k in itertools.count(2)))
        taken[next(x for x in candidates if x not in taken)] = position
    return [(columns[position], name) for name, position in taken.items()]


def rename_source_columns(df: DataFrame) -> DataFrame:
    """Drug / SMILES -> smiles, Y -> label, only if the target name is free."""
    out = df
    for src, dst in (("Drug", "smiles"), ("SMILES", "smiles"), ("Y", "label")):
        if src in out.columns and dst not in out.columns:
            out = out.withColumnRenamed(src, dst)
    return out


def clean_header(df: DataFrame) -> DataFrame:
    """Strip BOM and blanks from column names."""
    return df.toDF(*[c.replace("﻿", "").strip() for c in df.columns])


def drop_nested_columns(df: DataFrame) -> DataFrame:
    """Drop list / dict (array, map) columns by schema."""
    return df.select(*[_q(f.name) for f in df.schema.fields
                       if not isinstance(f.dataType, (T.ArrayType, T.MapType))])


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs -> ``a.b`` columns (recursive, schema only)."""
    def walk(dt, prefix, path):
        cols = []
        for f in dt.fields:
            name = f"{prefix}{sep}{f.name}" if prefix else f.name
            p = f"{path}.`{f.name}`" if path else f"`{f.name}`"
            if isinstance(f.dataType, T.StructType):
                cols.extend(walk(f.dataType, name, p))
            else:
                cols.append(F.col(p).alias(name))
        return cols
    return df.select(*walk(df.schema, "", ""))


def invalid_key_mask(df: DataFrame, key: str, canon: Column, drop_invalid: bool = True) -> DataFrame:
    """``canon`` is the canonicaliser's output (NULL = failed)."""
    out = df.withColumn("__canon", canon)
    if drop_invalid:
        out = out.filter(F.col("__canon").isNotNull())
    return out.withColumn(key, F.coalesce(F.col("__canon"), _q(key))).drop("__canon")


LABELLED_COLUMNS = ["molecule_chembl_id", "__row_index", "canonical_smiles", "standard_value", "class"]


def labelled_projection(df: DataFrame, keep_all: bool = False) -> DataFrame:
    """After class labelling keep the known id / key / value / class
    columns that are present (or everything with ``keep_all``)."""
    if keep_all:
        return df
    cols = [c for c in LABELLED_COLUMNS if c in df.columns]
    return df.select(*[_q(c) for c in cols]) if cols else df


def coerce_target(df: DataFrame, col: str, min_fraction: float = 0.9) -> DataFrame:
    """Convert the target to numbers only if at least ``min_fraction``
    of its non-null cells parse (one aggregate decides); otherwise leave it."""
    parsed = _q(col).cast("string").try_cast("double")
    r = df.agg(F.count(_q(col)).alias("n"), F.count(parsed).alias("ok")).first()
    if r["n"] and r["ok"] / r["n"] >= min_fraction:
        return df.withColumn(col, parsed)
    return df
