"""Model queries (M1-M13, X10): lineitem, regression target
``l_extendedprice / 1000`` and classification target ``l_returnflag = 'R'``,
split by T1 on the row id.  Fitted models cannot be checked against SQL:
rows-only, except the aggregate part of M10."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import models as M
from tessera.operators.correlation import correlations
from tessera.operators.kernel_svm import fit_kernel_svm
from tessera.operators.split import random_holdout, repeated_kfold
from tessera.plans import register
from tessera.session import ensure_checkpoint_dir, written
from tessera.sources.tables import ROW_INDEX, lineitem_rows, table

REG_FEATURES = ["l_quantity", "l_discount", "l_tax"]
CLS_FEATURES = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def model_table(spark, sf_dir):
    li = lineitem_rows(spark, sf_dir).select(
        ROW_INDEX, "l_quantity", "l_discount", "l_tax", "l_extendedprice",
        (F.col("l_extendedprice") / 1000).alias("y_reg"), (F.col("l_returnflag") == "R").cast("double").alias("y_cls"))
    return random_holdout(li, test_size=0.2, val_size=0.1, seed=42, keep_columns=True)


def _fit_score(spark, sf_dir, model_type, task):
    d = written(model_table(spark, sf_dir), "model-rows")
    feats, label = (REG_FEATURES, "y_reg") if task == "regression" else (CLS_FEATURES, "y_cls")
    model = M.fit(d.filter(F.col("split") == "train"), feats, label, model_type, task)
    return d, model, M.score(model, d, task), label


@register("m1_random_forest_fit_score")
def m1(spark, sf_dir):
    _, _, scored, label = _fit_score(spark, sf_dir, "random_forest", "regression")
    return M.split_metrics(scored, label, "regression")


@register("m2_decision_tree_fit_score")
def m2(spark, sf_dir):
    _, _, scored, label = _fit_score(spark, sf_dir, "decision_tree", "classification")
    return M.split_metrics(scored, label, "classification")


@register("m3_boosted_trees_with_validation")
def m3(spark, sf_dir):
    """Boosted trees with the val rows as early-stopping set
    (``validationIndicatorCol``)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    d = model_table(spark, sf_dir).withColumn("is_val", F.col("split") == "val")
    fit_rows = d.filter(F.col("split") != "test")
    gbt = GBTRegressor(maxIter=30, maxDepth=4, seed=42, labelCol="y_reg", validationIndicatorCol="is_val",
                       validationTol=0.01)
    model = Pipeline(stages=[VectorAssembler(inputCols=REG_FEATURES, outputCol="features"), gbt]).fit(fit_rows)
    return M.split_metrics(M.score(model, d, "regression"), "y_reg", "regression")


@register("m4_linear_svm")
def m4(spark, sf_dir):
    _, _, scored, label = _fit_score(spark, sf_dir, "svm", "classification")
    return M.split_metrics(scored, label, "classification")


@register("m4_rbf_svc_split_metrics")
def m4_svc(spark, sf_dir):
    """RBF support vectors, classification: metrics per split."""
    d = written(model_table(spark, sf_dir), "svm")
    model = fit_kernel_svm(d.where("split = 'train'"), CLS_FEATURES, "y_cls", "classification", components=64)
    return M.fit_step_metrics(model.score(d), "y_cls")


@register("m4_rbf_svr_split_metrics")
def m4_svr(spark, sf_dir):
    """RBF support vectors, regression: metrics per split."""
    d = written(model_table(spark, sf_dir), "svm")
    model = fit_kernel_svm(d.where("split = 'train'"), REG_FEATURES, "y_reg", "regression", components=64)
    return M.split_metrics(model.score(d), "y_reg", "regression")


@register("m5_voting_ensemble")
def m5(spark, sf_dir):
    d = written(model_table(spark, sf_dir), "model-rows")
    train = d.filter(F.col("split") == "train")
    scored = [M.score(M.fit(train, REG_FEATURES, "y_reg", t, "regression"), d, "regression")
              for t in ("random_forest", "boosted_trees")]
    ens = M.ensemble(scored, ROW_INDEX, "pred_0").join(d.select(ROW_INDEX, "y_reg", "split"), ROW_INDEX)
    return M.split_metrics(ens, "y_reg", "regression")


M6_SPACE = {"numTrees": [5, 10, 20], "maxDepth": [3, 4, 6], "minInstancesPerNode": [1, 5, 20]}


@register("m6_hyperparameter_search_cv")
def m6(spark, sf_dir):
    """Ten settings of 27, five folds (the operator's default is 100 draws)."""
    train = model_table(spark, sf_dir).filter(F.col("split") == "train")
    return M.sampled_search(train, REG_FEATURES, "y_reg", "random_forest", "regression", M6_SPACE, n_draws=10)


@register("m7_fit_step_split_metrics")
def m7(spark, sf_dir):
    """Fit on train, one transform of the whole split table, metrics per split."""
    _, _, scored, label = _fit_score(spark, sf_dir, "random_forest", "classification")
    return M.fit_step_metrics(scored, label)


@register("m7_fit_step_predictions")
def m7_predictions(spark, sf_dir):
    """The fit step's prediction table: every row of every split."""
    _, _, scored, label = _fit_score(spark, sf_dir, "random_forest", "classification")
    return scored.select(ROW_INDEX, "split", label, "pred_score", "pred_proba", "pred_label")


@register("m8_batch_score_persisted_model")
def m8(spark, sf_dir):
    """Persist the fitted pipeline to the shared checkpoint folder, reload it
    and score (S20 + M8)."""
    import os
    import uuid
    from pyspark.ml import PipelineModel
    d, model, _, _ = _fit_score(spark, sf_dir, "decision_tree", "regression")
    path = os.path.join(ensure_checkpoint_dir(spark), f"model-{uuid.uuid4().hex}")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    return M.score(loaded, d.drop("split"), "regression").select(ROW_INDEX, "pred_0")


@register("m10_multi_seed_benchmark", None)
def m10(spark, sf_dir):
    """Seeds x models -> per-run metrics -> mean and population std per model."""
    d = written(model_table(spark, sf_dir), "model-rows")
    train = d.filter(F.col("split") == "train")
    runs = None
    for seed in range(5):
        for t in ("random_forest", "decision_tree"):
            m = M.fit(train, REG_FEATURES, "y_reg", t, "regression", seed=seed)
            r = M.split_metrics(M.score(m, d, "regression"), "y_reg", "regression").filter(F.col("split") == "test") \
                .select(F.lit(t).alias("model_type"), F.lit(seed).alias("seed"), "r2", "mae")
            runs = r if runs is None else runs.unionByName(r)
    return M.benchmark_summary(runs, "model_type", ["r2", "mae"])


@register("m10_benchmark_summary_of_stored_runs", """
WITH runs AS (SELECT event_type AS model_type, user_id % 5 AS seed, avg(value) AS r2, max(value) AS mae FROM events GROUP BY 1, 2)
SELECT model_type, count(*) AS n_runs, round(avg(r2), 6) AS r2_mean, round(stddev_pop(r2), 6) AS r2_std,
       round(avg(mae), 6) AS mae_mean, round(stddev_pop(mae), 6) AS mae_std FROM runs GROUP BY 1""")
def m10_summary(spark, sf_dir):
    """The aggregate of the benchmark over a stored run table: five seeds per
    model, their metrics taken from events."""
    e = table(spark, sf_dir, "events")
    runs = e.groupBy(F.col("event_type").alias("model_type"), (F.col("user_id") % 5).alias("seed")).agg(F.avg("value").alias("r2"), F.max("value").alias("mae"))
    out = M.benchmark_summary(runs, "model_type", ["r2", "mae"])
    return out.select("model_type", "n_runs", *[F.round(c, 6).alias(c) for c in out.columns[2:]])


@register("m11_model_leaderboard")
def m11(spark, sf_dir):
    d = written(model_table(spark, sf_dir), "model-rows")
    train = d.filter(F.col("split") == "train")
    out = None
    for t in M.REGRESSORS:
        m = M.fit(train, REG_FEATURES, "y_reg", t, "regression")
        r = M.split_metrics(M.score(m, d, "regression"), "y_reg", "regression").filter(F.col("split") == "test") \
            .select(F.lit(t).alias("model_type"), "r2", "mae")
        out = r if out is None else out.unionByName(r)
    return out.orderBy(F.desc("r2"))


@register("m12_permutation_importance")
def m12(spark, sf_dir):
    d, model, _, label = _fit_score(spark, sf_dir, "random_forest", "regression")
    test = d.filter(F.col("split") == "test").drop("split")
    return M.permutation_importance(model, test, REG_FEATURES, label, "regression")


@register("m13_top20_importances")
def m13(spark, sf_dir):
    """Feature importances of the fitted forest, top 20 (a top-k report)."""
    _, model, _, _ = _fit_score(spark, sf_dir, "random_forest", "regression")
    imp = model.stages[-1].featureImportances.toArray().tolist()
    t = spark.createDataFrame(list(zip(REG_FEATURES, [float(x) for x in imp])), "feature string, importance double")
    return M.top_importances(t)


M13_COLUMNS = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey"]


@register("m13_top20_correlation_importances", "SELECT feature, round(importance, 6) AS importance FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr({c}, l_extendedprice)) AS importance FROM lineitem" for c in M13_COLUMNS)
    + ") ORDER BY importance DESC, feature LIMIT 20")
def m13_correlation(spark, sf_dir):
    """The same report over a model-free importance: |r| with the target."""
    r = correlations(table(spark, sf_dir, "lineitem"), [*M13_COLUMNS, "l_extendedprice"]).where(F.col("j") == len(M13_COLUMNS))
    named = r.select(F.get(F.lit(M13_COLUMNS), F.col("i")).alias("feature"), F.abs("r").alias("importance"))
    return M.top_importances(named).select("feature", F.round("importance", 6).alias("importance"))


@register("x10_stable_top_k_features")
def x10(spark, sf_dir):
    """Importances averaged over 5 shuffled folds of the training rows
    (forest refit per fold), top k (ties by column order).  The rows are stored
    with their fold and added up in one scan for all folds."""
    feats = CLS_FEATURES
    train = written(model_table(spark, sf_dir).filter(F.col("split") == "train").select(ROW_INDEX, *feats, "y_reg"), "model-rows")
    d = written(repeated_kfold(train, k=5, repeats=1, seed=42, keep_columns=True).select(*feats, "y_reg", "fold"), "folds")
    acc = [0.0] * len(feats)
    for m in M.fit_without_folds(d, feats, "y_reg", "random_forest", "regression", "fold", 5, seed=42):
        for i, v in enumerate(m.stages[-1].featureImportances.toArray().tolist()):
            acc[i] += v / 5
    rows = [(c, i, float(v)) for i, (c, v) in enumerate(zip(feats, acc))]
    t = spark.createDataFrame(rows, "feature string, position int, importance double")
    return t.orderBy(F.desc("importance"), "position").limit(50)
