"""Preprocessing queries (X1-X9, X11): lineitem numeric features, training
rows = the T1 train part (seed 42, test 0.2, val 0.1) of lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import preprocess as X
from tessera.operators.align import row_overlap
from tessera.operators.split import random_holdout
from tessera.plans import register
from tessera.plans.splits import _holdout_sql
from tessera.session import written
from tessera.sources.tables import LINEITEM_KEY_SQL, ROW_INDEX, lineitem_rows

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_gross", "l_disc10"]


def _features(spark, sf_dir):
    li = lineitem_rows(spark, sf_dir)
    return li.select(ROW_INDEX, "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                     (F.col("l_extendedprice") * (1 + F.col("l_tax"))).alias("l_gross"),
                     (F.col("l_discount") * 10).alias("l_disc10"))


def _with_split(spark, sf_dir):
    """Features joined with their split, written once to the shared checkpoint
    folder: the fit makes several passes and the transform another, and none of
    them should recompute the split (a lost executor re-reads the table instead
    of re-ranking)."""
    f = _features(spark, sf_dir)
    return written(random_holdout(f, test_size=0.2, val_size=0.1, seed=42, keep_columns=True), "split")


BASE_SQL = (f"base AS (SELECT {LINEITEM_KEY_SQL} AS rid, l_quantity, l_extendedprice, l_discount, l_tax, "
            "l_extendedprice * (1 + l_tax) AS l_gross, l_discount * 10 AS l_disc10 FROM lineitem),"
            + _holdout_sql("base", "rid", 42, 0.2, 0.1))


def _fit_sql(scaler: str, train_filter: str = "split = 'train'", var_t: float = X.DEFAULT_VARIANCE_THRESHOLD,
             corr_t: float = X.DEFAULT_CORR_THRESHOLD) -> str:
    """DuckDB CTEs ``fit`` (feature, scaler, center, scale, scaled_variance,
    passes_variance, corr_dropped) mirroring ``preprocess.fit``."""
    stats = []
    for c in FEATURES:
        if scaler == "robust":
            stats.append(f"quantile_cont({c}, [0.25, 0.5, 0.75]) AS {c}__q")
        elif scaler == "standard":
            stats += [f"avg({c}) AS {c}__mean", f"stddev_pop({c}) AS {c}__sd"]
        elif scaler == "minmax":
            stats += [f"min({c}) AS {c}__min", f"max({c}) AS {c}__max"]
        stats.append(f"var_pop({c}) AS {c}__var")
    pairs = [(i, j) for j in range(len(FEATURES)) for i in range(j)]
    corrs = [f"corr({FEATURES[i]}, {FEATURES[j]}) AS c_{i}_{j}" for i, j in pairs]
    rows = []
    for c in FEATURES:
        if scaler == "robust":
            center = f"{c}__q[2]"
            scale = f"CASE WHEN {c}__q[3] - {c}__q[1] = 0 THEN 1.0 ELSE {c}__q[3] - {c}__q[1] END"
        elif scaler == "standard":
            center = f"{c}__mean"
            scale = f"CASE WHEN {c}__sd = 0 THEN 1.0 ELSE {c}__sd END"
        elif scaler == "minmax":
            center = f"{c}__min"
            scale = f"CASE WHEN {c}__max - {c}__min = 0 THEN 1.0 ELSE {c}__max - {c}__min END"
        else:
            center, scale = "0.0", "1.0"
        rows.append(f"SELECT '{c}' AS feature, '{scaler}' AS scaler, CAST({center} AS DOUBLE) AS center, "
                    f"CAST({scale} AS DOUBLE) AS scale, {c}__var / (({scale}) * ({scale})) AS scaled_variance FROM st")
    fit_rows = " UNION ALL ".join(rows)
    drop_exprs = []
    for j, c in enumerate(FEATURES):
        terms = [f"(p{i}.passes_variance AND abs(cc.c_{i}_{j}) > {corr_t})" for i in range(j)]
        cond = " OR ".join(terms) if terms else "false"
        drop_exprs.append(f"WHEN '{c}' THEN coalesce(({cond}), false)")
    joins = " ".join(f"JOIN pv p{i} ON p{i}.feature = '{FEATURES[i]}'" for i in range(len(FEATURES)))
    return f"""
tr AS (SELECT * FROM h WHERE {train_filter}),
st AS (SELECT {", ".join(stats)} FROM tr),
cc AS (SELECT {", ".join(corrs)} FROM tr),
f0 AS ({fit_rows}),
pv AS (SELECT *, scaled_variance > {var_t} AS passes_variance FROM f0),
fit AS (SELECT x.feature, x.scaler, x.center, x.scale, x.scaled_variance, x.passes_variance,
               x.passes_variance AND CASE x.feature {" ".join(drop_exprs)} END AS corr_dropped
        FROM pv x, cc {joins})"""


FIT_COLS = ("feature, scaler, round(center, 6) AS center, round(scale, 6) AS scale, "
            "round(scaled_variance, 6) AS scaled_variance, passes_variance, corr_dropped")


# Min-max scaled columns live in [0, 1] (variance <= 0.25; uniform = 1/12),
# so the default 0.16 threshold would keep none: use 0.05 there.
VAR_T = {"robust": X.DEFAULT_VARIANCE_THRESHOLD, "standard": X.DEFAULT_VARIANCE_THRESHOLD, "minmax": 0.05,
         "none": X.DEFAULT_VARIANCE_THRESHOLD}


def _fit_query(scaler: str, cols: str):
    def q(spark, sf_dir):
        d = _with_split(spark, sf_dir)
        fitted = X.fit(d.filter(F.col("split") == "train"), FEATURES, scaler=scaler, variance_threshold=VAR_T[scaler], stored=True)
        t = fitted.table(spark)
        t = t.select("feature", "scaler", F.round("center", 6).alias("center"), F.round("scale", 6).alias("scale"),
                     F.round("scaled_variance", 6).alias("scaled_variance"), "passes_variance", "corr_dropped")
        wanted = ["feature", "scaler", "center", "scale", "scaled_variance", "passes_variance", "corr_dropped"]
        if cols == ID_COLS:
            wanted.remove("scaled_variance")
        return t.select(*wanted)
    return q


# Unscaled variances are ~1e9: compare only the decisions for the identity scaler.
ID_COLS = "feature, scaler, round(center, 6) AS center, round(scale, 6) AS scale, passes_variance, corr_dropped"
for _name, _scaler, _cols in (("x1_robust_scale_fit", "robust", FIT_COLS),
                              ("x2_standard_scale_fit", "standard", FIT_COLS),
                              ("x3_minmax_scale_fit", "minmax", FIT_COLS),
                              ("x4_identity_scale_fit", "none", ID_COLS)):
    register(_name, "WITH " + BASE_SQL + "," + _fit_sql(_scaler, var_t=VAR_T[_scaler]) + f"\nSELECT {_cols} FROM fit")(
        _fit_query(_scaler, _cols))


def _transform_sql(scaler: str, train_filter: str = "split = 'train'") -> str:
    """Per split, per kept feature: mean / min / max of the transformed value."""
    var_t = VAR_T[scaler]
    longs = []
    for c in FEATURES:
        s = f"(h.{c} - fit.center) / fit.scale"
        if scaler == "minmax":
            s = f"least(greatest({s}, 0.0), 1.0)"
        if scaler == "none":
            s = f"h.{c}"
        s = f"least(greatest({s}, -1e10), 1e10)"
        longs.append(f"SELECT h.split, '{c}' AS feature, {s} AS v FROM h JOIN fit ON fit.feature = '{c}' "
                     "WHERE fit.passes_variance AND NOT fit.corr_dropped")
    return ("WITH " + BASE_SQL + "," + _fit_sql(scaler, train_filter, var_t=var_t) + ",\nlong AS (" + " UNION ALL ".join(longs) + ")"
            "\nSELECT split, feature, round(avg(v), 6) AS mean_value, round(min(v), 6) AS min_value, "
            "round(max(v), 6) AS max_value FROM long GROUP BY ALL")


def _transform_query(scaler: str, full_fit: bool = False):
    def q(spark, sf_dir):
        d = _with_split(spark, sf_dir)
        fitted = X.fit(d if full_fit else d.filter(F.col("split") == "train"), FEATURES, scaler=scaler,
                       variance_threshold=VAR_T[scaler], stored=True)
        t = X.transform(d, fitted, keep=["split"])
        long = t.select("split", F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("v"))
                                                     for c in fitted.kept])).alias("s")).select("split", "s.*")
        return long.groupBy("split", "feature").agg(F.round(F.avg("v"), 6).alias("mean_value"),
                                                    F.round(F.min("v"), 6).alias("min_value"),
                                                    F.round(F.max("v"), 6).alias("max_value"))
    return q


register("x3_minmax_clipped_transform", _transform_sql("minmax"))(_transform_query("minmax"))
register("x7_x8_train_only_fit_transform", _transform_sql("robust"))(_transform_query("robust"))
register("x9_full_data_fit_transform", _transform_sql("robust", "true"))(_transform_query("robust", full_fit=True))


@register("x5_low_variance_filter", "WITH " + BASE_SQL + "," + _fit_sql("robust", var_t=0.3)
          + "\nSELECT feature, round(scaled_variance, 6) AS scaled_variance, passes_variance FROM fit")
def x5(spark, sf_dir):
    d = _with_split(spark, sf_dir).filter(F.col("split") == "train")
    fitted = X.fit(d, FEATURES, scaler="robust", variance_threshold=0.3, stored=True)
    return fitted.table(spark).select("feature", F.round("scaled_variance", 6).alias("scaled_variance"),
                                      "passes_variance")


@register("x6_correlation_prune", "WITH " + BASE_SQL + "," + _fit_sql("standard", corr_t=0.9)
          + "\nSELECT feature, passes_variance, corr_dropped FROM fit")
def x6(spark, sf_dir):
    d = _with_split(spark, sf_dir).filter(F.col("split") == "train")
    fitted = X.fit(d, FEATURES, scaler="standard", corr_threshold=0.9, stored=True)
    return fitted.table(spark).select("feature", "passes_variance", "corr_dropped")


@register("x8_leakage_check_after_transform", "WITH " + BASE_SQL + """,
tr AS (SELECT DISTINCT l_quantity, l_discount FROM h WHERE split = 'train')
SELECT count(*) AS n_test_rows_seen_in_train FROM h WHERE split = 'test'
  AND EXISTS (SELECT 1 FROM tr WHERE tr.l_quantity IS NOT DISTINCT FROM h.l_quantity
              AND tr.l_discount IS NOT DISTINCT FROM h.l_discount)""")
def x8_leak(spark, sf_dir):
    d = _with_split(spark, sf_dir)
    cols = ["l_quantity", "l_discount"]
    return row_overlap(d.filter(F.col("split") == "train").select(*cols),
                       d.filter(F.col("split") == "test").select(*cols), cols).agg(
        F.count(F.lit(1)).alias("n_test_rows_seen_in_train"))


@register("x8_leakage_check_all_features", "WITH " + BASE_SQL + f""",
tr AS (SELECT DISTINCT {", ".join(FEATURES)} FROM h WHERE split = 'train')
SELECT count(*) AS n_test_rows_seen_in_train FROM h WHERE split = 'test'
  AND EXISTS (SELECT 1 FROM tr WHERE {" AND ".join(f"tr.{c} IS NOT DISTINCT FROM h.{c}" for c in FEATURES)})""")
def x8_leak_all(spark, sf_dir):
    """Two columns have few value pairs, which any large train part holds: a
    row is seen in train only if all its features are."""
    d = _with_split(spark, sf_dir)
    return row_overlap(d.filter(F.col("split") == "train").select(*FEATURES),
                       d.filter(F.col("split") == "test").select(*FEATURES), FEATURES).agg(
        F.count(F.lit(1)).alias("n_test_rows_seen_in_train"))


@register("x11_quality_checks", """
WITH g AS (SELECT l_returnflag, l_linestatus, l_quantity, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows, sum(n) > count(*) AS has_duplicates,
       CAST((SELECT (count(DISTINCT l_returnflag) = 1)::INT + (count(DISTINCT l_linestatus) = 1)::INT
               + (count(DISTINCT l_quantity) = 1)::INT FROM lineitem) AS BIGINT) AS n_constant_columns FROM g""")
def x11(spark, sf_dir):
    from tessera.sources.tables import table
    li = table(spark, sf_dir, "lineitem")
    return X.quality_checks(li, ["l_returnflag", "l_linestatus", "l_quantity"])


LINEITEM_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                    "l_returnflag", "l_linestatus", "l_shipdate"]


@register("x11_quality_checks_all_columns", f"""
WITH g AS (SELECT {", ".join(LINEITEM_COLUMNS)}, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows, sum(n) > count(*) AS has_duplicates,
       CAST((SELECT {" + ".join(f"(count(DISTINCT {c}) = 1)::INT" for c in LINEITEM_COLUMNS)} FROM lineitem) AS BIGINT) AS n_constant_columns FROM g""")
def x11_all(spark, sf_dir):
    from tessera.sources.tables import table
    li = table(spark, sf_dir, "lineitem")
    return X.quality_checks(li, li.columns)
