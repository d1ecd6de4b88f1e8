"""Trees and forests from one scan of the rows.

A tree of ``pyspark.ml`` sees a row as its bins (at most ``maxBins`` a feature)
and its label, and adds up counts, sums and squares of labels.  So the rows are
added up once: per cell (one bin of every feature), and per fold where there are
folds.  The estimators of ``pyspark.ml`` are then fitted on the cells.  A cell of
n rows with mean m and deviation d stands there as labels m - d and m + d with
weight n / 2 each: count, sum and squares are those of its rows, and so are the
gains, the leaves, and R^2 on cells.  For classes, a cell has one row per class.

A forest's bootstrap is drawn per row, as in ``pyspark.ml``: in the scan every
row gets a Poisson(1) count for every tree, and cells are kept per tree.  Each
tree is fitted on its own cells, with the forest's choice of features per node,
and the trees are put into one forest model.

Bins are cut as in ``pyspark.ml``: between distinct values, if a sample has at
most ``maxBins`` of them, else at its quantiles.  All rows are counted.  Cells
times trees times folds are at most ``LIMIT``; with more features ``cells`` is
None and callers fit on the rows.  Rows with a missing feature are left out.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import import_in_workers, written

LIMIT = 1 << 24
SAMPLE = 100_000  # rows of four features
PARALLEL = 8
ALL_ROWS = -1  # the tree number of the cells without bootstrap


def cut_points(values: np.ndarray, max_bins: int) -> list[float]:
    """At most ``max_bins - 1`` thresholds, each between two neighbouring distinct values."""
    distinct, counts = np.unique(values[np.isfinite(values)], return_counts=True)
    at = np.arange(1, len(distinct))
    if len(distinct) > max_bins:
        below = np.cumsum(counts)
        at = np.unique(np.searchsorted(below, below[-1] * np.arange(1, max_bins) / max_bins) + 1)
        at = at[at < len(distinct)]
    return [float(c) for c in np.unique((distinct[at - 1] + distinct[at]) / 2)]


@dataclass
class Cells:
    """Counts, sums and squares by (fold, tree, cell), and how the cells are cut."""

    table: DataFrame
    feature_cols: list[str]
    cuts: list[list[float]]
    classes: int
    center: float
    few: bool  # a tree's cells are work for one task; its passes then need no shuffle
    stored: dict = field(default_factory=dict)

    def kept(self, tree: int, without: int | None = None) -> DataFrame:
        """``points``, stored until ``release``."""
        key = (tree, without)
        if key not in self.stored:
            self.stored[key] = self.points(tree, without).cache()
        return self.stored[key]

    def release(self) -> None:
        while self.stored:
            self.stored.popitem()[1].unpersist()

    def points(self, tree: int, without: int | None = None, only: int | None = None) -> DataFrame:
        """The weighted points (features, label, w) of one tree's cells, without a fold or of one."""
        rows = self.table.where(F.col("tree") == tree)
        if without is not None:
            rows = rows.where(F.col("fold") != without)
        if only is not None:
            rows = rows.where(F.col("fold") == only)
        if self.few:
            rows = rows.coalesce(1)
        rows = rows.groupBy("cell").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])
        if self.classes:
            rows = rows.select(F.expr(f"cell div {self.classes}").alias("cell"), F.col("n").alias("w"), F.expr(f"double(cell % {self.classes})").alias("label"))
        else:
            mean = F.col("s") / F.col("n")
            spread = F.sqrt(F.greatest(F.col("q") / F.col("n") - mean * mean, F.lit(0.0)))
            rows = rows.select("cell", (F.col("n") / 2).alias("w"), F.explode(F.array(mean - spread, mean + spread)).alias("label"))
            rows = rows.withColumn("label", F.col("label") + self.center)
        codes, below = [], 1
        for i in reversed(range(len(self.cuts))):
            width = len(self.cuts[i]) + 1
            codes.append(F.expr(f"double((cell div {below}) % {width})").alias(f"__code{i}"))
            below *= width
        rows = rows.select("w", "label", *codes)
        return self._assembler().transform(rows).select("features", "label", "w")

    def _assembler(self) -> VectorAssembler:
        return VectorAssembler(inputCols=[f"__code{i}" for i in range(len(self.cuts))], outputCol="features")

    def pipeline(self, model) -> PipelineModel:
        """``model``, fitted on cells, as a model of rows."""
        ends = [[-float("inf"), *(c or [0.0]), float("inf")] for c in self.cuts]
        bins = Bucketizer(splitsArray=ends, inputCols=self.feature_cols, outputCols=[f"__code{i}" for i in range(len(ends))], handleInvalid="skip")
        return PipelineModel([bins, self._assembler(), model])


def is_forest(est) -> bool:
    return isinstance(est, (RandomForestRegressor, RandomForestClassifier))


def cells(rows: DataFrame, feature_cols: list[str], label: str, est, n_trees: int, classification: bool, fold_col: str | None = None, folds: int = 1) -> Cells | None:
    """Add up ``rows``: for ``ALL_ROWS`` and ``n_trees`` bootstraps, by ``fold_col`` (0 .. folds - 1)."""
    import_in_workers(rows.sparkSession)
    d = len(feature_cols)
    if hasattr(est, "getSubsamplingRate") and est.getSubsamplingRate() != 1.0:
        return None
    fold = F.col(f"`{fold_col}`").cast("int") if fold_col else F.lit(0)
    rows = rows.select(F.col(f"`{label}`").cast("double").alias("y"), fold.alias("fold"), *[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(feature_cols)])
    rows = rows.na.drop(subset=[f"x{i}" for i in range(d)])
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.max("y").alias("top"), F.count_if(F.col("y").isNull() | F.isnan("y")).alias("bad")).first()
    if not found["n"] or found["bad"]:
        raise ValueError(f"{label}: no complete row to fit on" if not found["n"] else f"{label}: {found['bad']} labels are missing")
    sample = rows.sample(min(1.0, SAMPLE * 4 / d / found["n"]), seed=est.getSeed()).drop("fold").toPandas().to_numpy(np.float64)
    cuts = [cut_points(sample[:, i + 1], est.getMaxBins()) for i in range(d)]
    widths = [len(c) + 1 for c in cuts]
    classes = int(found["top"]) + 1 if classification else 0
    size = int(np.prod(widths, dtype=float)) * max(classes, 1)
    if size * folds * (n_trees + 1) > LIMIT:
        return None
    center = float(sample[:, 0].mean()) if len(sample) and not classification else 0.0
    seed = est.getSeed() % (1 << 32)

    def add_up(batches):
        rng = np.random.default_rng([seed, TaskContext.get().partitionId()])
        sums = np.zeros((1 if classes else 3, n_trees + 1, folds * size))
        for b in batches:
            y, at = b.column(0).to_numpy(), np.zeros(len(b), np.int64)
            for i in range(d):
                at = at * widths[i] + np.searchsorted(cuts[i], b.column(2 + i).to_numpy(), side="right")
            if classes:
                at = at * classes + y.astype(np.int64)
            at += b.column(1).to_numpy().astype(np.int64) * size
            y = y - center
            for t in range(n_trees + 1):
                w = np.ones(len(b)) if t == 0 else rng.poisson(1.0, len(b)).astype(np.float64)
                for power in range(len(sums)):
                    np.add.at(sums[power, t], at, w * y**power if power else w)
        for t in range(n_trees + 1):
            held = np.flatnonzero(sums[0, t])
            for start in range(0, len(held), 50_000):
                at = held[start : start + 50_000]
                values = [pa.array(sums[p, t, at] if p < len(sums) else np.zeros(len(at))) for p in range(3)]
                yield pa.RecordBatch.from_arrays([pa.array((at // size).astype(np.int32)), pa.array(np.full(len(at), t - 1, np.int32)), pa.array(at % size), *values], ["fold", "tree", "cell", "n", "s", "q"])

    # a task emits all its cells, so no more tasks than cores
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = rows.coalesce(cores).mapInArrow(add_up, "fold int, tree int, cell long, n double, s double, q double")
    table = parts.groupBy("fold", "tree", "cell").agg(*[F.sum(c).alias(c) for c in ("n", "s", "q")])
    return Cells(written(table.repartition(n_trees + 1, "tree"), "cells"), list(feature_cols), cuts, classes, center, size * folds <= 1_000_000)


def fit_cells(found: Cells, est, without: int | None = None):
    """The estimator's model on the cells, without those of one fold; a forest
    tree by tree.  The points stay stored for other settings (``Cells.release``)."""
    if not is_forest(est):
        return est.setLabelCol("label").setWeightCol("w").fit(found.kept(ALL_ROWS, without))
    n_trees, least = est.getNumTrees(), est.getMinInstancesPerNode()
    subset = est.getFeatureSubsetStrategy()
    if subset == "auto":
        subset = "all" if n_trees == 1 else "sqrt" if found.classes else "onethird"
    sc = found.table.sparkSession.sparkContext

    def one(t: int):
        points = found.kept(t, without)
        total = (points.agg(F.sum("w")).first()[0] or 0.0) if least > 1 else 0.0
        tree = est.copy().setLabelCol("label").setWeightCol("w").setNumTrees(1).setBootstrap(False).setFeatureSubsetStrategy(subset).setSeed(est.getSeed() + t)
        # rows, not points, are counted for the least number in a node
        tree.setMinInstancesPerNode(1)
        if least > 1 and least > total / 2:
            tree.setMaxDepth(0)
        elif least > 1:
            tree.setMinWeightFractionPerNode((least - 0.5) / total)
        return tree.fit(points)

    with ThreadPoolExecutor(PARALLEL) as pool:
        models = list(pool.map(inheritable_thread_target(found.table.sparkSession)(one), range(n_trees)))
    kind = "classification.DecisionTreeClassificationModel" if found.classes else "regression.DecisionTreeRegressionModel"
    java = sc._gateway.new_array(_java(sc, kind), n_trees)
    for i, m in enumerate(models):
        java[i] = m._java_obj.trees()[0]
    if found.classes:
        forest = RandomForestClassificationModel(_java(sc, "classification.RandomForestClassificationModel")(models[0].uid, java, len(found.cuts), models[0].numClasses))
    else:
        forest = RandomForestRegressionModel(_java(sc, "regression.RandomForestRegressionModel")(models[0].uid, java, len(found.cuts)))
    forest._resetUid(models[0].uid)
    return forest._set(numTrees=n_trees).setFeaturesCol("features")


def r_squared(scored: DataFrame, center: float) -> float:
    """R^2 of the rows that weighted points stand for.  (RegressionEvaluator takes
    weights for reliabilities and returns more.)"""
    t, w = F.col("label") - center, F.col("w")
    r = scored.agg(F.sum(w).alias("n"), F.sum(w * t).alias("s"), F.sum(w * t * t).alias("q"), F.sum(w * (F.col("label") - F.col("prediction")) ** 2).alias("e")).first()
    with np.errstate(divide="ignore", invalid="ignore"):
        return float(1 - np.float64(r.e) / np.float64(r.q - r.s * r.s / r.n)) if r.n else float("nan")


def _java(sc, name: str):
    at = sc._jvm.org.apache.spark.ml
    for part in name.split("."):
        at = getattr(at, part)
    return at
