"""Experiment-grid tables.

A grid is a table of cases: factor maps (``map<string,string>`` with dotted
keys), their execution slices, ids, fingerprints and rule violations.  The
grid is bounded by the size guard (G11: the product of axis sizes is checked
in one aggregate before anything is expanded), so windows over the grid's
parent table are over at most ``max_cases`` rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.bijection import permute

DEFAULT_MAX_CASES = 10_000
# Keys removed before hashing a runtime config (G5) and, in addition, the
# execution-slice indices removed for the scientific id.
VOLATILE_KEYS = ["global.base_dir", "global.run_dir", "global.artifact_retention", "global.runs.id"]
SLICE_KEYS = ["split.cv.fold_index", "split.cv.repeat_index", "split.inner.fold_index", "split.inner.repeat_index"]


def sanitize(c: Column) -> Column:
    """G12 token: not alphanumeric, '_' or '-' -> '_', outer '_' stripped, empty -> 'x'."""
    s = F.regexp_replace(F.regexp_replace(c.cast("string"), r"[^\p{L}\p{N}_-]", "_"), r"^_+|_+$", "")
    return F.when(s == "", F.lit("x")).otherwise(s)


def axes_row(axes: dict[str, DataFrame], max_cases: int = DEFAULT_MAX_CASES) -> DataFrame:
    """One local row: map axis -> sorted distinct values.  Each axis is a
    one-column DataFrame derived from data; at most ``max_cases`` + 1 values of
    an axis leave its distinct, so no axis larger than the grid limit is ever
    gathered.  Nulls are no values."""
    long = reduce(lambda a, b: a.unionByName(b), [
        df.select(F.lit(name).alias("axis"), F.col(f"`{df.columns[0]}`").cast("string").alias("value")).where("value is not null").distinct().limit(max_cases + 1)
        for name, df in axes.items()])
    values: dict[str, list[str]] = {name: [] for name in axes}
    for r in long.collect():
        values[r["axis"]].append(r["value"])
    too_big = sorted(a for a, v in values.items() if len(v) > max_cases)
    if too_big:
        raise ValueError(f"grid axes above max_cases={max_cases}: {too_big}")
    spark = next(iter(axes.values())).sparkSession
    return spark.createDataFrame([({a: sorted(v, key=lambda x: x.encode()) for a, v in values.items()},)], "axes map<string,array<string>>")


def size_guard(row: DataFrame, names: list[str], max_cases: int = DEFAULT_MAX_CASES) -> int:
    """Product of axis sizes, refused above ``max_cases``."""
    sizes = row.select(*[F.size(F.col("axes")[n]).alias(n) for n in names]).first()
    total = 1
    for n in names:
        if sizes[n] == 0:
            raise ValueError(f"grid axis {n!r} is empty")
        total *= sizes[n]
    if total > max_cases:
        raise ValueError(f"Expanded grid has {total} combinations > max_cases={max_cases}")
    return total


def decoded(numbers: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    """A number column ``combo_index`` decoded to factor values: mixed radix
    over the axes in name order, the first the slowest."""
    out, stride = numbers, 1
    for n in sorted(values, reverse=True):
        at = F.expr(f"int((combo_index div {stride}) % {len(values[n])})")
        out = out.withColumn(n, F.get(F.lit(values[n]), at))
        stride *= len(values[n])
    return out.select("combo_index", *[F.col(f"`{n}`") for n in sorted(values)])


def expand(row: DataFrame, names: list[str]) -> DataFrame:
    """Cartesian product of the axes, axes in sorted name order, with the
    product position ``combo_index``: each row decodes its own number.  The
    size guard bounds the rows, so they are one partition, and what is numbered
    or grouped over the grid needs no shuffle."""
    axes = row.first()["axes"]
    total = 1
    for n in names:
        total *= len(axes[n])
    numbers = row.sparkSession.range(0, total, 1, 1).select(F.col("id").alias("combo_index"))
    return decoded(numbers, {n: axes[n] for n in names})


def draw_cases(row: DataFrame, names: list[str], k: int, seed: int = 42) -> DataFrame:
    """k different cases of the grid (all, if there are fewer) without
    expanding it: drawn numbers (``draw`` is their order), decoded."""
    axes = row.first()["axes"]
    total = 1
    for n in names:
        total *= len(axes[n])
    drawn = [(i, int(x)) for i, x in enumerate(permute(np.arange(min(k, total)), total, seed))]
    numbers = row.sparkSession.createDataFrame(drawn, "draw int, combo_index long")
    return decoded(numbers.select("combo_index"), {n: axes[n] for n in names}).join(numbers, "combo_index")


def overlay(defaults: dict[str, str], factors: Column) -> Column:
    """Case factors override defaults (dotted keys)."""
    d = F.create_map(*[x for k, v in sorted(defaults.items()) for x in (F.lit(k), F.lit(v))])
    keep = F.map_filter(d, lambda k, v: ~F.array_contains(F.map_keys(factors), k))
    return F.map_concat(keep, factors)


def get_dotted(m: Column, key: str, default: str | None = None) -> Column:
    """G1: read a dotted key."""
    v = m.getItem(key)
    return F.coalesce(v, F.lit(default)) if default is not None else v


def _below(k: Column, key: str) -> Column:
    return (k == key) | k.startswith(key + ".")


def _path(key: str) -> str:
    return ".".join(p for p in key.split(".") if p)


def set_dotted(m: Column, key: str, value: Column | str | None) -> Column:
    """G1: the map with ``key`` set; what stood below the key, or as a value
    above it, goes.  An empty key changes nothing, a null map is an empty one."""
    key = _path(key)
    base = F.coalesce(m, F.create_map().cast("map<string,string>"))
    if not key:
        return base
    parts = key.split(".")
    above = [".".join(parts[:i]) for i in range(1, len(parts))]
    kept = F.map_filter(base, lambda k, v: ~_below(k, key) & (~k.isin(*above) if above else F.lit(True)))
    return F.map_concat(kept, F.create_map(F.lit(key), (value if isinstance(value, Column) else F.lit(value)).cast("string")))


def remove_dotted(m: Column, key: str) -> Column:
    """G1: the map without ``key`` and all below it (parents left empty have no
    entry in a flat map, so they go too)."""
    key = _path(key)
    return F.map_filter(m, lambda k, v: ~_below(k, key)) if key else m


def extract_prefixed(m: Column, prefix: str) -> Column:
    """G1: the entries whose key starts with ``prefix``, under the rest of it;
    the key that equals the prefix is left out."""
    hits = F.filter(F.map_entries(m), lambda e: e["key"].startswith(prefix) & (F.length(e["key"]) > len(prefix)))
    rest = F.transform(hits, lambda e: F.struct(F.substring(e["key"], len(prefix) + 1, 1 << 30).alias("key"), e["value"].alias("value")))
    return F.map_from_entries(rest)


def canonical(m: Column, drop: list[str]) -> Column:
    """Sorted ``key=value`` list of a map without ``drop`` keys (G1 remove)."""
    kept = F.map_filter(m, lambda k, v: ~k.isin(*drop)) if drop else m
    return F.concat_ws(",", F.array_sort(F.transform(F.map_entries(kept),
                                                     lambda e: F.concat(e["key"], F.lit("="), e["value"]))))


def config_fingerprint(m: Column) -> Column:
    """sha256 of the canonical config without volatile keys."""
    return F.sha2(canonical(m, VOLATILE_KEYS), 256)


def scientific_id(m: Column) -> Column:
    """G5 without the fold / repeat indices (groups slices of a config)."""
    return F.sha2(canonical(m, VOLATILE_KEYS + SLICE_KEYS), 256)


def _slice_numbers(m: Column) -> tuple[Column, Column, Column, Column, Column, Column]:
    """(mode, stage, is CV, is inner CV, folds, repeats) of a merged config."""
    mode = F.lower(F.trim(get_dotted(m, "split.mode", "holdout")))
    stage = F.lower(F.trim(get_dotted(m, "split.stage", "inner")))
    cv = mode == "cv"
    inner = (mode == "nested_holdout_cv") & (stage == "inner")
    folds = F.when(cv, get_dotted(m, "split.cv.n_splits", "5")).when(inner, get_dotted(m, "split.inner.n_splits", "5")) \
        .cast("int")
    reps = F.when(cv, get_dotted(m, "split.cv.repeats", "1")).when(inner, get_dotted(m, "split.inner.repeats", "1")) \
        .cast("int")
    n_f = F.greatest(F.coalesce(folds, F.lit(1)), F.lit(1))
    n_r = F.greatest(F.coalesce(reps, F.lit(1)), F.lit(1))
    return mode, stage, cv, inner, n_f, n_r


def execution_count(m: Column) -> Column:
    """Slices of a merged config, without expanding them."""
    *_, n_f, n_r = _slice_numbers(m)
    return (n_f * n_r).cast("long")


def execution_slices(cases: DataFrame, merged: str = "merged") -> DataFrame:
    """CV -> repeats x folds; nested (inner stage) the same on the inner
    keys; otherwise one slice.  Adds the slice factors to the merged map."""
    m = F.col(merged)
    mode, stage, cv, inner, n_f, n_r = _slice_numbers(m)
    out = cases.withColumn("execution_count", (n_f * n_r).cast("long")) \
        .withColumn("__slice", F.explode(F.sequence(F.lit(0), n_f * n_r - 1)))
    r = (F.col("__slice") / n_f).cast("int")
    f = F.col("__slice") % n_f
    prefix = F.when(cv, F.lit("split.cv.")).when(inner, F.lit("split.inner."))
    slice_map = F.when(prefix.isNotNull(), F.create_map(F.concat(prefix, F.lit("fold_index")), f.cast("string"),
                                                        F.concat(prefix, F.lit("repeat_index")), r.cast("string")))
    out = out.withColumn(merged, F.when(slice_map.isNotNull(), F.map_concat(m, slice_map)).otherwise(m))
    label = F.when(cv, F.format_string("rep%d_fold%d", r, f)) \
        .when(inner, F.format_string("inner_rep%d_fold%d", r, f)) \
        .when(mode == "nested_holdout_cv", stage).otherwise(mode)
    tokens = F.when(cv, F.array(F.format_string("rep%d", r), F.format_string("fold%d", f))) \
        .when(inner, F.array(F.lit("inner"), F.format_string("rep%d", r), F.format_string("fold%d", f))) \
        .when(mode == "nested_holdout_cv", F.array(stage)).otherwise(F.array().cast("array<string>"))
    return out.withColumn("execution_label", label).withColumn("execution_tokens", tokens) \
        .withColumnRenamed("__slice", "slice_index")


def rule_issues(rules: list[tuple[str, str, str, Column]]) -> Column:
    """``array_compact(array(when(rule, struct(code, path, message)), ...))``."""
    items = [F.when(pred, F.struct(F.lit(code).alias("code"), F.lit(path).alias("path"), F.lit(msg).alias("message")))
             for code, path, msg, pred in rules]
    return F.array_compact(F.array(*items))


def numbered(df: DataFrame, order: str, fmt: str, out: str) -> DataFrame:
    """G12 / parent ids: ``fmt % position`` over a bounded grid table."""
    return df.withColumn(out, F.format_string(fmt, F.row_number().over(Window.orderBy(order))))


def dotted_map(df: DataFrame, struct_col: str) -> Column:
    """G1: a nested struct (e.g. a parsed JSON config) -> ``map<string,string>``
    with dotted keys, built from the schema (no per-row Python)."""
    from pyspark.sql import types as T

    def walk(dt, path, name):
        out = []
        for f in dt.fields:
            p = f"{path}.`{f.name}`"
            key = f"{name}.{f.name}" if name else f.name
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, p, key)
            else:
                out.append((key, F.col(p).cast("string")))
        return out

    entries = walk(df.schema[struct_col].dataType, f"`{struct_col}`", "")
    return F.map_filter(F.create_map(*[x for k, v in entries for x in (F.lit(k), v)]), lambda k, v: v.isNotNull())
