"""Model fit, scoring and explanation on ``pyspark.ml``.

Estimators are built from a registry (B4).  A fit step scores the whole split
table in one ``transform`` (not once per split); metrics come from the exact
metric operators.  Trees and forests are fitted on cells of binned rows
(``binned_trees``): the rows are read in one scan, whatever the number of trees,
settings and folds.  Permutation importance moves feature values by a keyed
bijection of stored row ranks, all repeats and columns in one job; the search
draws settings from a numbered space and scores them on one fold table.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                       RandomForestClassifier)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.bijection import draw, permute
from tessera.operators.binned_trees import ALL_ROWS, cells, fit_cells, is_forest, r_squared
from tessera.operators.metrics import auc_ap, classification_counts, regression_metrics
from tessera.operators.ranks import bucketed_rank
from tessera.operators.split import repeated_kfold
from tessera.session import import_in_workers, written
from tessera.sources.tables import ROW_INDEX

# Model registry.  No RBF kernel SVM / SVR in Spark: ``svm`` is linear.
REGRESSORS: dict[str, Callable] = {
    "random_forest": lambda seed: RandomForestRegressor(numTrees=20, maxDepth=6, seed=seed),
    "decision_tree": lambda seed: DecisionTreeRegressor(maxDepth=8, seed=seed),
    "boosted_trees": lambda seed: GBTRegressor(maxIter=20, maxDepth=4, seed=seed),
}
CLASSIFIERS: dict[str, Callable] = {
    "random_forest": lambda seed: RandomForestClassifier(numTrees=20, maxDepth=6, seed=seed),
    "decision_tree": lambda seed: DecisionTreeClassifier(maxDepth=8, seed=seed),
    "boosted_trees": lambda seed: GBTClassifier(maxIter=20, maxDepth=4, seed=seed),
    "svm": lambda seed: LinearSVC(maxIter=50, regParam=0.01),
}
TREES = ("random_forest", "decision_tree", "boosted_trees")


def build(model_type: str, task: str, seed: int = 42, label: str = "label", features: str = "features"):
    reg = REGRESSORS if task == "regression" else CLASSIFIERS
    if model_type not in reg:
        raise ValueError(f"unknown model type {model_type!r} for {task}; known: {sorted(reg)}")
    est = reg[model_type](seed)
    return est.setLabelCol(label).setFeaturesCol(features)


def fit(train: DataFrame, feature_cols: list[str], label: str, model_type: str, task: str,
        seed: int = 42) -> PipelineModel:
    """M1-M4 / M7: the estimator fitted on the training rows; trees on their cells."""
    est = build(model_type, task, seed, label)
    if model_type in TREES:
        found = cells(train, feature_cols, label, est, _bags(est), task != "regression")
        if found is not None:
            model = found.pipeline(fit_cells(found, est))
            found.release()
            return model
    asm = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[asm, est]).fit(train)


def _bags(est) -> int:
    return est.getNumTrees() if is_forest(est) else 0


def fit_without_folds(train: DataFrame, feature_cols: list[str], label: str, model_type: str, task: str, fold_col: str, folds: int,
                      seed: int = 42) -> list[PipelineModel]:
    """Per fold 0 .. folds - 1 of ``fold_col`` the model fitted on the rows of
    the others; the rows are added up once for all folds."""
    est = build(model_type, task, seed, label)
    if model_type in TREES:
        found = cells(train, feature_cols, label, est, _bags(est), task != "regression", fold_col, folds)
        if found is not None:
            models = []
            for f in range(folds):
                models.append(found.pipeline(fit_cells(found, est.copy(), f)))
                found.release()
            return models
    return [fit(train.filter(F.col(fold_col) != f), feature_cols, label, model_type, task, seed) for f in range(folds)]


def score(model: PipelineModel, df: DataFrame, task: str) -> DataFrame:
    """M8 / M9: regression ``pred_0``; classification pred_proba (probability
    of class 1, or sigmoid of the raw margin for margin-only models) and
    pred_label at 0.5."""
    out = model.transform(df)
    out = out.drop(*[c for c in out.columns if c.startswith("__code") and c not in df.columns])
    if task == "regression":
        return out.withColumn("pred_0", F.col("prediction")).drop("features", "prediction")
    if "probability" in out.columns:
        proba = vector_to_array("probability")[1]
    else:
        proba = 1 / (1 + F.exp(-vector_to_array("rawPrediction")[1]))
    out = out.withColumn("pred_proba", proba).withColumn("pred_score", F.col("pred_proba")) \
        .withColumn("pred_label", (F.col("pred_proba") >= 0.5).cast("int"))
    return out.drop(*[c for c in ("features", "rawPrediction", "probability", "prediction") if c in out.columns])


def split_metrics(scored: DataFrame, label: str, task: str, by: str = "split") -> DataFrame:
    """M7 / K9: metrics per split of one scored table."""
    if task == "regression":
        return regression_metrics(scored, label, "pred_0", by=by)
    return auc_ap(scored, label, "pred_proba", by=by)


def fit_step_metrics(scored: DataFrame, label: str, by: str = "split") -> DataFrame:
    """M7: auc, auprc, accuracy and F1 per split of one scored table, stored:
    three passes read it, and no row is scored twice."""
    scored = written(scored.select(by, label, "pred_proba", "pred_label"), "scored")
    counts = classification_counts(scored, label, "pred_label", by=by).select(by, "accuracy", "f1")
    return auc_ap(scored, label, "pred_proba", by=by).join(counts, by)


def ensemble(scored: list[DataFrame], id_col: str, pred_col: str) -> DataFrame:
    """M5: mean prediction (soft vote = mean probability) over models scored
    on the same rows, joined on the row id."""
    base = scored[0].select(id_col, F.col(pred_col).alias("__p0"))
    for i, s in enumerate(scored[1:], start=1):
        base = base.join(s.select(id_col, F.col(pred_col).alias(f"__p{i}")), id_col)
    mean = sum(F.col(f"__p{i}") for i in range(len(scored))) / len(scored)
    return base.select(id_col, mean.alias(pred_col))


def permutation_importance(model: PipelineModel, df: DataFrame, feature_cols: list[str], label: str, task: str,
                           n_repeats: int = 10, seed: int = 42, id_col: str = ROW_INDEX) -> DataFrame:
    """Per feature, mean drop of R^2 (regression) or AUROC when the
    column is permuted, greatest first.

    Rows are ranked once and stored.  In repeat r the values of rank i go to
    the row of rank p_r(i), a keyed bijection of the ranks, so one shuffle of
    feature values by rank serves all features: a feature's permuted copy
    differs from the row in that feature only."""
    spark = df.sparkSession
    import_in_workers(spark)
    features = [F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(feature_cols)]
    ranked = bucketed_rank(df.select(id_col, F.col(label).alias("__y"), *features), F.md5(F.col(id_col).cast("string")), tie_cols=[id_col], out="__rank")
    ranked = written(ranked, "ranked")
    n, width = ranked.count(), len(feature_cols)

    def donate(batches):
        for b in batches:
            rank = b.column(0).to_numpy() - 1
            for r in range(n_repeats):
                to = permute(rank, n, seed + r)
                yield pa.RecordBatch.from_arrays([pa.array(to + 1), pa.array(np.full(len(to), r, np.int32)), *b.columns[1:]], ["__to", "__r", *[f"d{i}" for i in range(width)]])

    schema = ", ".join(["__to long", "__r int", *[f"d{i} double" for i in range(width)]])
    donors = ranked.select("__rank", *[f"f{i}" for i in range(width)]).mapInArrow(donate, schema)
    variants = [
        F.struct(F.lit(j).alias("__f"), *[F.col(f"d{i}" if i == j else f"f{i}").alias(c) for i, c in enumerate(feature_cols)]) for j in range(width)
    ]
    rows = ranked.join(donors, F.col("__rank") == F.col("__to")).select(F.col("__y").alias(label), "__r", F.explode(F.array(*variants)).alias("__v"))
    rows = rows.select(label, (F.col("__r") * width + F.col("__v")["__f"]).alias("__perm"), *[F.col("__v")[c].alias(c) for c in feature_cols])
    plain = ranked.select(F.col("__y").alias(label), *[F.col(f"f{i}").alias(c) for i, c in enumerate(feature_cols)])
    if task == "regression":
        m = regression_metrics(score(model, rows, task), label, "pred_0", by="__perm").select("__perm", F.col("r2").alias("m"))
        base = regression_metrics(score(model, plain, task), label, "pred_0").select(F.col("r2").alias("base"))
    else:
        m = auc_ap(score(model, rows, task), label, "pred_proba", by="__perm", max_groups=width * n_repeats).select("__perm", F.col("auc").alias("m"))
        base = auc_ap(score(model, plain, task), label, "pred_proba").select(F.col("auc").alias("base"))
    name = F.get(F.lit(list(feature_cols)), (F.col("__perm") % width).cast("int"))
    per = m.join(base, how="inner").select(name.alias("feature"), (F.col("base") - F.col("m")).alias("drop"))
    out = per.groupBy("feature").agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
    return out.orderBy(F.desc("importance_mean"), "feature")


def top_importances(importances: DataFrame, k: int = 20) -> DataFrame:
    """The k most important features (feature, importance), ties by name."""
    return importances.select("feature", "importance").orderBy(F.desc("importance"), "feature").limit(k)


def benchmark_summary(runs: DataFrame, by: str, metrics: list[str]) -> DataFrame:
    """Mean and population standard deviation of each metric over the
    runs (seeds) of each ``by``; runs without a value do not count."""
    aggs = [x for m in metrics for x in (F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std"))]
    return runs.groupBy(by).agg(F.count(F.lit(1)).alias("n_runs"), *aggs)


def sampled_search(train: DataFrame, feature_cols: list[str], label: str, model_type: str, task: str, space: dict[str, list], n_draws: int = 100,
                   folds: int = 5, seed: int = 42, id_col: str = ROW_INDEX, parallelism: int = 4) -> DataFrame:
    """M6: ``n_draws`` settings drawn without replacement from the product of
    ``space`` (all of them, if there are fewer), each scored by cross
    validation on one stored fold table (trees: on its cells): mean R^2, or mean accuracy.  One row
    per draw (draw, params, mean_score), best first, ties in drawn order.  The
    space is numbered, not expanded."""
    names = sorted(space)
    if not names or not all(space[n] for n in names):
        raise ValueError("every searched parameter needs a value")
    est = build(model_type, task, seed, label)
    drawn = [{n: space[n][i] for n, i in zip(names, at)} for at in draw([len(space[n]) for n in names], n_draws, seed)]
    table = repeated_kfold(train.select(id_col), k=folds, repeats=1, seed=seed, id_col=id_col).select(id_col, F.col("fold").cast("int").alias("__fold"))
    if task == "regression":
        judge = RegressionEvaluator(labelCol=label, metricName="r2")
    else:
        judge = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    maps = [{est.getParam(n): v for n, v in d.items()} for d in drawn]
    rows = written(train.select(id_col, label, *feature_cols).join(table, id_col).drop(id_col), "folds")
    scores = None
    if model_type in TREES and not {"maxBins", "subsamplingRate", "bootstrap", "minWeightFractionPerNode"} & set(names):
        bags = max(_bags(est.copy(m)) for m in maps)
        found = cells(rows, feature_cols, label, est, bags, task != "regression", "__fold", folds)
        if found is not None:
            judge = judge.setLabelCol("label").setWeightCol("w")
            held = [found.points(ALL_ROWS, only=f).cache() for f in range(folds)]

            def judged(at: tuple[int, int]) -> float:
                model = fit_cells(found, est.copy(maps[at[0]]), at[1])
                scored = model.transform(held[at[1]])
                return r_squared(scored, found.center) if task == "regression" else judge.copy().evaluate(scored)

            with ThreadPoolExecutor(2) as pool:
                by_fold = list(pool.map(inheritable_thread_target(train.sparkSession)(judged), itertools.product(range(len(maps)), range(folds))))
            scores = [float(np.mean(by_fold[i * folds : (i + 1) * folds])) for i in range(len(maps))]
            found.release()
            for h in held:
                h.unpersist()
    if scores is None:
        rows = VectorAssembler(inputCols=feature_cols, outputCol="features", handleInvalid="skip").transform(rows).select(label, "features", "__fold")
        cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=judge, numFolds=folds, foldCol="__fold", parallelism=parallelism)
        scores = [float(m) for m in cv.fit(rows).avgMetrics]
    found = [(i, {n: str(v) for n, v in d.items()}, m) for i, (d, m) in enumerate(zip(drawn, scores))]
    return train.sparkSession.createDataFrame(found, "draw int, params map<string,string>, mean_score double").orderBy(F.desc("mean_score"), "draw")
