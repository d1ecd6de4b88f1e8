"""Exploratory summaries (H8-H23): the tables behind the reference's plots.

Wide summaries are one aggregate pass; per-column results are unpivoted to a
long ``(column, ...)`` table.  Only bounded tables are collected: one row of
min/max per histogram column, the fence table of box statistics.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.correlation import correlations
from tessera.operators.radix_select import column_quantiles
from tessera.operators.ranks import bounded_broadcast

# Fixed values that must equal the reference's behaviour.
BINARY_TOKENS = ["0", "1", "false", "true", "inactive", "active", "no", "yes", "n", "y"]
HIST_BINS = 30


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def is_missing(c: str, dtype: str) -> Column:
    col = _q(c)
    if dtype in ("double", "float"):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def _stack(row_exprs: list[tuple[str, Column]], value_name: str) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(n).alias("column"), e.alias(value_name)) for n, e in row_exprs]))


def overview(df: DataFrame, numeric_cols: list[str]) -> DataFrame:
    """H8: rows, columns, numeric columns, missing cells (one pass)."""
    dtypes = dict(df.dtypes)
    miss = reduce(lambda a, b: a + b, [F.count_if(is_missing(c, dtypes[c])) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), miss.cast("long").alias("missing_cells")).select(
        "n_rows", F.lit(len(df.columns)).cast("long").alias("n_columns"),
        F.lit(len(numeric_cols)).cast("long").alias("n_numeric_columns"), "missing_cells")


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing count per column (long form, one pass)."""
    dtypes = dict(df.dtypes)
    wide = df.agg(*[F.count_if(is_missing(c, dtypes[c])).alias(c) for c in df.columns])
    return wide.select(_stack([(c, _q(c)) for c in df.columns], "n_missing").alias("s")).select("s.*")


def missingness_top(df: DataFrame, k: int = 20) -> DataFrame:
    """H9: columns with missing values, most first (top-k report)."""
    return missing_counts(df).filter(F.col("n_missing") > 0).orderBy(F.desc("n_missing"), "column").limit(k)


def numeric_fraction(df: DataFrame, target: str | None = None) -> DataFrame:
    """Per column (target excluded) the fraction of cells that parse as
    numbers; numeric iff >= 0.5 and at least one parses."""
    cols = [c for c in df.columns if c != target]
    parsed = {c: _q(c).cast("string").try_cast("double") for c in cols}
    wide = df.agg(*[F.count(parsed[c]).alias(f"{c}__n") for c in cols], F.count(F.lit(1)).alias("__rows"))
    long = wide.select("__rows", _stack([(c, _q(f"{c}__n")) for c in cols], "n_numeric").alias("s")).select(
        "__rows", "s.*")
    frac = F.col("n_numeric") / F.col("__rows")
    return long.select("column", "n_numeric", F.round(frac, 6).alias("numeric_fraction"),
                       ((F.col("n_numeric") > 0) & (frac >= 0.5)).alias("is_numeric"))


def numeric_columns(df: DataFrame, target: str | None = None) -> list[str]:
    rows = numeric_fraction(df, target).filter("is_numeric").select("column").collect()
    keep = {r[0] for r in rows}
    return [c for c in df.columns if c in keep]


def histograms(df: DataFrame, cols: list[str], bins: int = HIST_BINS) -> DataFrame:
    """Equal-width bins over [min, max] per column, last bin closed,
    empty bins kept (zero fill by exploding ``sequence(0, bins-1)``)."""
    vals = {c: F.when(~F.isnan(_q(c).cast("double")), _q(c).cast("double")) for c in cols}
    long = df.select(_stack([(c, vals[c]) for c in cols], "v").alias("s")).select("s.*").filter(F.col("v").isNotNull())
    rng = long.groupBy("column").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    rng = bounded_broadcast(rng, len(cols))
    w = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("v") - F.col("lo")) / w), F.lit(bins - 1))).cast("int")
    counts = long.join(rng, "column").groupBy("column", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select("column", "lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counts, ["column", "bin"], "left").select(
        "column", "bin", (F.col("lo") + F.col("bin") * w).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * w).alias("bin_end"), F.coalesce("n", F.lit(0)).alias("count"))


def correlation_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pairwise-complete Pearson r for all given columns, one scan, long
    form (col_a < col_b in column order)."""
    names = F.array(*[F.lit(c) for c in cols])
    return correlations(df, cols).select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"), "r")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Counts of the string value, missing counted as 'nan', most first."""
    key = F.coalesce(_q(col).cast("string"), F.lit("nan"))
    return df.groupBy(key.alias("value")).agg(F.count(F.lit(1)).alias("count"))


def box_stats(df: DataFrame, class_col: str, cols: list[str], max_classes: int = 1000) -> DataFrame:
    """Per class and column: quartiles (linear), 1.5 IQR fences, the
    most extreme points inside them (whiskers) and the outlier count.  The
    values stay in their rows: four passes of counters for the quartiles, one
    aggregate by class for the rest."""
    values = df.select(F.col(f"`{class_col}`").cast("string").alias("class"), *[_q(c).cast("double").alias(c) for c in cols])
    q = column_quantiles(values, cols, [0.25, 0.5, 0.75], ["class"], max_classes, stored=True)
    q = q.select("class", "column", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3"))
    fences = q.withColumn("lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).withColumn("hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    wide = fences.groupBy(F.col("class").alias("__class")).agg(F.map_from_entries(F.collect_list(F.struct("column", F.struct("lo", "hi")))).alias("__f"))
    joined = values.join(bounded_broadcast(wide, max_classes), F.col("class").eqNullSafe(F.col("__class")))
    aggs = []
    for i, c in enumerate(cols):
        v, fence = _q(c), F.col("__f")[c]
        known = v.isNotNull() & ~F.isnan(v)
        inside = known & (v >= fence["lo"]) & (v <= fence["hi"])
        aggs.append(F.struct(F.lit(c).alias("column"), F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
                             F.count_if(known & ~inside).alias("n_outliers"), F.count_if(known).alias("n")).alias(f"__a{i}"))
    found = joined.groupBy("class").agg(*aggs).select(F.col("class").alias("__class"), F.explode(F.array(*[f"__a{i}" for i in range(len(cols))])).alias("a"))
    same = q["class"].eqNullSafe(found["__class"]) & (q["column"] == found["a"]["column"])
    return q.join(found, same).select("class", q["column"], "q1", "median", "q3", "a.whisker_low", "a.whisker_high", "a.n_outliers", "a.n")


def class_density(df: DataFrame, class_col: str, col: str, grid: int = 100, bins: int = 256) -> DataFrame:
    """Gaussian KDE per class (Scott bandwidth ``std * n**-0.2``) on a
    ``grid``-point axis over the class range, from ``bins`` weighted bin
    centres (binning first keeps it linear in the data)."""
    v = _q(col).cast("double")
    base = df.select(F.col(class_col).cast("string").alias("class"), v.alias("v")).filter(
        F.col("v").isNotNull() & ~F.isnan("v"))
    st = base.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                                   F.min("v").alias("lo"), F.max("v").alias("hi"))
    st = st.withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))) \
        .withColumn("w", (F.col("hi") - F.col("lo")) / bins)
    st = bounded_broadcast(st, 1000)
    b = F.when(F.col("w") == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("v") - F.col("lo")) / F.col("w")),
                                                              F.lit(bins - 1))).cast("int")
    binned = base.join(st, "class").groupBy("class", b.alias("b")).agg(F.count(F.lit(1)).alias("nb"))
    pts = binned.join(st, "class").withColumn("c", F.col("lo") + (F.col("b") + 0.5) * F.col("w")) \
        .withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    x = F.col("lo") + F.col("k") * (F.col("hi") - F.col("lo")) / (grid - 1)
    u = (x - F.col("c")) / F.col("h")
    dens = F.col("nb") * F.exp(-0.5 * u * u) / (F.col("n") * F.col("h") * F.lit((2 * 3.141592653589793) ** 0.5))
    return pts.groupBy("class", "k").agg(F.first(x).alias("x"), F.sum(dens).alias("density"))


def rule_compliance(flags: DataFrame, rules: list[str]) -> DataFrame:
    """Pass-all / fail-any, per-rule pass and fail counts, and the
    pass-count distribution len(rules)..0 zero-filled; long form (metric, key, count)."""
    n_pass = reduce(lambda a, b: a + b, [F.col(r).cast("int") for r in rules])
    k = len(rules)
    aggs = [F.count_if(n_pass == k).alias("pass_all"), F.count_if(n_pass < k).alias("fail_any")]
    for r in rules:
        aggs += [F.count_if(F.col(r)).alias(f"pass__{r}"), F.count_if(~F.col(r)).alias(f"fail__{r}")]
    for i in range(k + 1):
        aggs.append(F.count_if(n_pass == i).alias(f"dist__{i}"))
    wide = flags.agg(*aggs)
    entries = [("compliance", "pass_all", "pass_all"), ("compliance", "fail_any", "fail_any")]
    entries += [("rule_pass", r, f"pass__{r}") for r in rules] + [("rule_fail", r, f"fail__{r}") for r in rules]
    entries += [("pass_count", str(i), f"dist__{i}") for i in range(k, -1, -1)]
    return wide.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(key).alias("key"),
                                                    F.col(c).cast("long").alias("count")) for m, key, c in entries]))
                       .alias("s")).select("s.*")


def probe(df: DataFrame, target: str, key_candidates: list[str] | None = None) -> DataFrame:
    """Rows, distinct target values, binary
    target test and the inferred task, in one aggregate; with ``key_candidates``
    also ``resolved_key``, the first of them that is a column (null if none is)."""
    t = _q(target)
    tok = F.lower(F.trim(t.cast("string")))
    num = t.cast("string").try_cast("double")
    agg = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(t).alias("n_distinct_target"),
        F.count(t).alias("n_non_null"),
        F.count_if(t.isNotNull() & num.isNull()).alias("n_non_numeric"),
        F.count_if(num.isNotNull() & ~num.isin(0.0, 1.0)).alias("n_numeric_not_01"),
        F.count_if(t.isNotNull() & (tok != "") & ~tok.isin(*BINARY_TOKENS)).alias("n_token_not_binary"),
        F.count_if(t.isNotNull() & (tok != "")).alias("n_tokens"),
    )
    numeric_binary = (F.col("n_non_numeric") == 0) & (F.col("n_numeric_not_01") == 0)
    token_binary = (F.col("n_tokens") > 0) & (F.col("n_token_not_binary") == 0)
    binary = (F.col("n_non_null") > 0) & (numeric_binary | token_binary)
    key = next((c for c in key_candidates or [] if c in df.columns), None)
    return agg.select("n_rows", "n_distinct_target", binary.alias("binary_target"),
                      F.when(binary, F.lit("classification")).otherwise(F.lit("regression")).alias("task_type"),
                      *([F.lit(key).cast("string").alias("resolved_key")] if key_candidates is not None else []))


TASKS = ("classification", "regression")


def resolved_task(requested: Column, confirmed: Column, binary: Column) -> Column:
    """``struct<task,problem>`` of a declared task.  A stated task stands;
    ``auto`` follows the target once confirmed; anything else is a problem, as is
    ``auto`` without confirmation or without a target (``binary`` null)."""
    asked = F.lower(F.trim(F.coalesce(requested, F.lit(""))))
    auto = asked == "auto"
    problem = F.when(asked.isin(*TASKS), F.lit(None)) \
        .when(~auto, "the task must be classification, regression or auto") \
        .when(~F.coalesce(confirmed, F.lit(False)), "an automatic task must be confirmed") \
        .when(binary.isNull(), "no target to infer the task from")
    task = F.when(asked.isin(*TASKS), asked).when(problem.isNull(), F.when(binary, TASKS[0]).otherwise(TASKS[1]))
    return F.struct(task.alias("task"), problem.alias("problem"))


def task_of(probed: DataFrame, requested: str, confirmed: bool = False) -> str:
    """H21 for one probed dataset: its task, or ValueError with the problem."""
    found = probed.select(resolved_task(F.lit(requested), F.lit(confirmed), F.col("binary_target")).alias("r")).first()["r"]
    if found["problem"]:
        raise ValueError(f"{found['problem']}: {requested!r}")
    return found["task"]


def contract_violations(df: DataFrame, required: list[str], any_of: list[list[str]], min_columns: int,
                        numeric: list[str]) -> DataFrame:
    """Violations table (rule, detail, count).  Schema rules are free;
    value rules (cells that should be numeric but do not parse) are one
    aggregate."""
    spark = df.sparkSession
    rows = []
    for c in required:
        if c not in df.columns:
            rows.append(("missing_required_column", c, 1))
    for group in any_of:
        if not any(c in df.columns for c in group):
            rows.append(("missing_any_of", "|".join(group), 1))
    if len(df.columns) < min_columns:
        rows.append(("too_few_columns", str(min_columns), len(df.columns)))
    schema_part = spark.createDataFrame(rows, "rule string, detail string, count long")
    present = [c for c in numeric if c in df.columns]
    if not present:
        return schema_part
    wide = df.agg(*[F.count_if(_q(c).isNotNull() & _q(c).cast("string").try_cast("double").isNull()).alias(c)
                    for c in present])
    vals = wide.select(F.explode(F.array(*[F.struct(F.lit("non_numeric_values").alias("rule"), F.lit(c).alias("detail"),
                                                    F.col(c).cast("long").alias("count")) for c in present])).alias("s")) \
        .select("s.*").filter(F.col("count") > 0)
    return schema_part.unionByName(vals)


# Words of a declared column type and how a cell is parsed for it.
ROW_TYPES = {"number": "double", "integer": "decimal(38,0)", "boolean": "boolean", "date": "date", "timestamp": "timestamp"}


def row_type_violations(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cells that do not parse as the declared type of their column (rule,
    detail, count), all rows in one aggregate.  ``string`` always holds, a null
    cell and an absent column (the schema rules' matter) too; an integer may be
    written 2.0 but not 2.5."""
    unknown = {t for t in types.values() if t != "string" and t not in ROW_TYPES}
    if unknown:
        raise ValueError(f"unknown row types {sorted(unknown)}; known: {['string', *ROW_TYPES]}")

    def wrong(c: str, t: str) -> Column:
        text = F.trim(_q(c).cast("string"))
        parsed = text.try_cast(ROW_TYPES[t])
        bad = parsed.isNull() if t != "integer" else parsed.isNull() | (text.try_cast("decimal(38,18)") % 1 != 0)
        return F.count_if(_q(c).isNotNull() & bad)

    checked = [c for c, t in types.items() if t != "string" and c in df.columns]
    if not checked:
        return df.sparkSession.createDataFrame([], "rule string, detail string, count long")
    counts = df.agg(*[wrong(c, types[c]).alias(f"n{i}") for i, c in enumerate(checked)])
    cells = [F.struct(F.lit(f"not_{types[c]}").alias("rule"), F.lit(c).alias("detail"), F.col(f"n{i}").cast("long").alias("count"))
             for i, c in enumerate(checked)]
    return counts.select(F.inline(F.array(*cells))).where("count > 0")


def checked_contract(df: DataFrame, name: str, required: list[str] = (), any_of: list[list[str]] = (), min_columns: int = 0,
                     types: dict[str, str] | None = None, mode: str = "warn") -> bool:
    """Whether the table keeps its contract.  ``warn`` warns of every
    violation and returns False, ``fail`` raises with all of them."""
    if mode not in ("warn", "fail"):
        raise ValueError(f"mode must be warn or fail, not {mode!r}")
    found = contract_violations(df, list(required), [g for g in any_of if g], min_columns, []).collect()
    found += row_type_violations(df, types or {}).collect()
    problems = [f"{r['rule']} {r['detail']} ({r['count']})" for r in found]
    if problems and mode == "fail":
        raise ValueError(f"{name}: " + "; ".join(problems))
    for p in problems:
        warnings.warn(f"{name}: {p}", stacklevel=2)
    return not problems


def shared_groups(df: DataFrame, keys: list[str], item: str) -> DataFrame:
    """Groups of more than one row and all their members, one row each
    (keys, n, member); a hot group is never gathered."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    counts = counts.select(*[F.col(k).alias(f"__{k}") for k in keys], "n")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return df.join(counts, same).select(*keys, "n", F.col(item).alias("member"))