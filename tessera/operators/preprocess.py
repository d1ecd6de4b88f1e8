"""Fit-on-train preprocessing.

``fit`` reads the training rows only: one aggregate for scale statistics and
raw population variances, four passes of counters for the quantiles of the
robust scaler, and one scan for the correlations of the variance survivors.
It returns a small fitted-statistics table.
``transform`` is a single ``select`` whose literals come from that table, so it
compiles into one codegen stage over any number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.correlation import correlations
from tessera.operators.radix_select import column_quantiles
from tessera.session import written

SCALERS = ("robust", "standard", "minmax", "none")
DEFAULT_VARIANCE_THRESHOLD = 0.8 * (1 - 0.8)
DEFAULT_CORR_THRESHOLD = 0.95
DEFAULT_CLIP = (-1e10, 1e10)


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


@dataclass
class Fitted:
    scaler: str
    features: list[str]
    center: dict[str, float]
    scale: dict[str, float]
    variance: dict[str, float]
    variance_features: list[str]
    corr_drop: list[str]
    clip_range: tuple[float, float]

    @property
    def kept(self) -> list[str]:
        return [c for c in self.variance_features if c not in self.corr_drop]

    def table(self, spark) -> DataFrame:
        """Fitted statistics as a DataFrame (persistable artifact, S20)."""
        rows = [(c, self.scaler, float(self.center[c]), float(self.scale[c]), float(self.variance[c]),
                 c in self.variance_features, c in self.corr_drop) for c in self.features]
        return spark.createDataFrame(rows, "feature string, scaler string, center double, scale double, "
                                           "scaled_variance double, passes_variance boolean, corr_dropped boolean")


def load_fitted(artifact: DataFrame, features: list[str] | None = None, clip_range: tuple[float, float] = DEFAULT_CLIP) -> Fitted:
    """A ``Fitted`` from its stored table, ready for ``transform``.
    ``features`` gives the column order (else by name: a table has none)."""
    rows = {r["feature"]: r for r in artifact.collect()}  # one row per feature
    order = features or sorted(rows)
    missing = [c for c in order if c not in rows]
    if missing or not rows:
        raise ValueError(f"the stored fit lacks {missing or 'all features'}")
    by = lambda name: {c: rows[c][name] for c in order}
    chosen = lambda name: [c for c in order if rows[c][name]]
    scaler = next(iter(rows.values()))["scaler"]
    return Fitted(scaler, list(order), by("center"), by("scale"), by("scaled_variance"), chosen("passes_variance"), chosen("corr_dropped"), clip_range)


def fit_step(rows: DataFrame, splits: DataFrame, features: list[str], label: str, path: str, id_col: str = "__row_index", **how) -> DataFrame:
    """Fit on the training rows, transform all, write ``features``,
    ``labels`` and ``fitted`` under ``path``, and return per part of the split
    how many rows equal a training row on every kept feature (leakage)."""
    part = rows.join(splits.select(id_col, "split"), id_col)
    fitted = fit(part.where("split = 'train'"), features, **how)
    transform(rows, fitted, keep=[id_col]).write.parquet(f"{path}/features")
    rows.select(id_col, label).write.parquet(f"{path}/labels")
    spark = rows.sparkSession
    fitted.table(spark).write.parquet(f"{path}/fitted")
    ready = spark.read.parquet(f"{path}/features").join(splits.select(id_col, "split"), id_col)
    train = ready.where("split = 'train'").select(*[_q(c) for c in fitted.kept]).distinct()
    train = train.select(*[_q(c).alias(f"__t{i}") for i, c in enumerate(fitted.kept)])
    same = reduce(lambda a, b: a & b, [_q(c).eqNullSafe(F.col(f"__t{i}")) for i, c in enumerate(fitted.kept)])
    rest = ready.where("split <> 'train'")
    seen = rest.join(train, same, "left_semi").groupBy("split").agg(F.count(F.lit(1)).alias("n_seen_in_train"))
    return rest.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows")).join(seen, "split", "left").na.fill(0, ["n_seen_in_train"])


def scale_stat_exprs(c: str, scaler: str) -> list[Column]:
    """Aggregates for the scale statistics (robust quantiles come from
    ``column_quantiles`` instead: no single-task value buffer)."""
    x = _q(c).cast("double")
    if scaler == "robust":
        return []
    if scaler == "standard":
        return [F.avg(x).alias(f"{c}__mean"), F.stddev_pop(x).alias(f"{c}__sd")]
    if scaler == "minmax":
        return [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    return []


def _center_scale(row, c: str, scaler: str) -> tuple[float, float]:
    if scaler == "robust":
        q25, q50, q75 = row[f"{c}__q"]
        rng = q75 - q25
        return q50, (rng if rng != 0 else 1.0)
    if scaler == "standard":
        sd = row[f"{c}__sd"]
        return row[f"{c}__mean"], (sd if sd not in (0, None) else 1.0)
    if scaler == "minmax":
        lo, hi = row[f"{c}__min"], row[f"{c}__max"]
        rng = hi - lo
        return lo, (rng if rng != 0 else 1.0)
    return 0.0, 1.0


def fit(train: DataFrame, features: list[str], scaler: str = "robust",
        variance_threshold: float = DEFAULT_VARIANCE_THRESHOLD, corr_threshold: float = DEFAULT_CORR_THRESHOLD,
        clip_range: tuple[float, float] = DEFAULT_CLIP, stored: bool = False) -> Fitted:
    """X1-X6 on training rows only.  X5 keeps columns whose *scaled*
    population variance is strictly above the threshold; X6 drops column j
    when any earlier column i (dropped or not) has |r| > threshold.  ``train``
    is read six times at most, so it should be stored (``stored=False`` writes
    its features to the checkpoint folder first)."""
    scaler = str(scaler or "robust").strip().lower()
    if scaler not in SCALERS:
        raise ValueError(f"unknown scaler {scaler!r}: robust, standard, minmax or none")
    train = train.select(*[_q(c).cast("double").alias(c) for c in features])
    if not stored:
        train = written(train, "train")
    aggs = []
    for c in features:
        aggs.append(F.avg(_q(c)).alias(f"{c}__avg"))
        aggs += scale_stat_exprs(c, scaler)
        aggs.append(F.var_pop(_q(c).cast("double")).alias(f"{c}__var"))
    row = train.agg(*aggs).first().asDict()
    if scaler == "robust":
        for r in column_quantiles(train, features, [0.25, 0.5, 0.75], stored=True).collect():  # one row per feature
            row[f"{r['column']}__q"] = (r["q0"], r["q1"], r["q2"])
    center, scale, variance = {}, {}, {}
    for c in features:
        center[c], scale[c] = _center_scale(row, c, scaler)
        raw = row[f"{c}__var"]
        variance[c] = (raw / (scale[c] ** 2)) if raw is not None else float("nan")
    survivors = [c for c in features if variance[c] > variance_threshold]
    if not survivors:
        raise ValueError(f"no feature has a scaled variance over {variance_threshold}")
    high = correlations(train, survivors, [row[f"{c}__avg"] for c in survivors]).where(F.abs("r") > corr_threshold)
    late = {r["j"] for r in high.select("j").distinct().collect()}  # positions of survivors
    drop = [c for j, c in enumerate(survivors) if j in late]
    return Fitted(scaler, list(features), center, scale, variance, survivors, drop, tuple(clip_range))


def scaled(c: str, fitted: Fitted) -> Column:
    x = _q(c).cast("double")
    out = (x - F.lit(fitted.center[c])) / F.lit(fitted.scale[c])
    if fitted.scaler == "minmax":  # MinMaxScaler(clip=True)
        out = F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))
    if fitted.scaler == "none":
        out = x
    return out


def transform(df: DataFrame, fitted: Fitted, keep: list[str] | None = None) -> DataFrame:
    """Scale -> variance subset -> correlation prune -> clip, one select."""
    lo, hi = fitted.clip_range
    other = [c for c in (keep or []) if c in df.columns]
    cols = []
    for c in fitted.kept:
        s = scaled(c, fitted)
        cols.append(F.when(s.isNull() | F.isnan(s), s).otherwise(F.least(F.greatest(s, F.lit(lo)), F.lit(hi))).alias(c))
    return df.select(*[_q(c) for c in other], *cols)


def quality_checks(df: DataFrame, cols: list[str]) -> DataFrame:
    """X11: duplicate rows present?  columns with exactly one distinct value."""
    dup = df.groupBy(*[_q(c) for c in cols]).count().agg(
        F.count(F.lit(1)).alias("n_distinct_rows"), F.sum("count").alias("n_rows"))
    # one value: smallest and largest agree (no distinct counts, which would multiply the rows)
    const = df.agg(*[F.when(F.min(_q(c)) == F.max(_q(c)), 1).otherwise(0).alias(c) for c in cols])
    n_const = sum([F.col(f"`{c}`") for c in cols])
    return dup.join(const.select(n_const.alias("n_constant_columns")), how="inner").select(
        "n_rows", "n_distinct_rows", (F.col("n_rows") > F.col("n_distinct_rows")).alias("has_duplicates"),
        F.col("n_constant_columns").cast("long").alias("n_constant_columns"))
