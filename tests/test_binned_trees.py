"""Trees fitted on cells of binned rows against the same trees on the rows."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from tessera.operators import binned_trees as B
from tessera.operators import models as M


def rows(spark, n=900):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 12, n), rng.integers(0, 7, n)
    y = 3.0 * a - 2.0 * b * (a > 6) + rng.normal(size=n)
    data = [(float(p), float(q), float(t), float(t > 8), int(i % 3)) for i, (p, q, t) in enumerate(zip(a, b, y))]
    data.append((None, 1.0, 0.0, 0.0, 0))
    return spark.createDataFrame(data, "a double, b double, y double, c double, fold int")


def test_cells_hold_the_sums_of_the_rows(spark):
    d = rows(spark)
    found = B.cells(d, ["a", "b"], "y", M.build("random_forest", "regression"), 4, False, "fold", 3)
    every = found.points(B.ALL_ROWS).collect()
    y = np.array([r.y for r in d.where("a is not null").collect()])
    w, t = np.array([r.w for r in every]), np.array([r.label for r in every])
    assert len(every) <= 2 * 12 * 7 and w.sum() == len(y)
    assert (w * t).sum() == pytest.approx(y.sum()) and (w * t * t).sum() == pytest.approx((y * y).sum())
    bags = [sum(r.w for r in found.points(i).collect()) for i in range(4)]
    assert len(set(bags)) > 1 and all(abs(x - len(y)) < 6 * len(y) ** 0.5 for x in bags)
    assert sum(r.w for r in found.points(B.ALL_ROWS, without=1).collect()) + sum(r.w for r in found.points(B.ALL_ROWS, only=1).collect()) == len(y)


@pytest.mark.parametrize("task,label", [("regression", "y"), ("classification", "c")])
def test_a_tree_on_cells_is_the_tree_on_rows(spark, task, label):
    d = rows(spark).where("a is not null")
    est = M.build("decision_tree", task, 42, label)
    plain = est.fit(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(d))
    model = M.fit(d, ["a", "b"], label, "decision_tree", task)
    want = plain.transform(VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(d)).select("a", "b", "prediction").distinct().collect()
    got = {(r.a, r.b): r.prediction for r in model.transform(d).select("a", "b", "prediction").distinct().collect()}
    assert len(got) == len(want) and all(got[r.a, r.b] == pytest.approx(r.prediction) for r in want)


def test_models_without_a_fold(spark):
    models = M.fit_without_folds(rows(spark), ["a", "b"], "y", "random_forest", "regression", "fold", 3)
    assert len(models) == 3 and all(m.stages[-1].getNumTrees == 20 for m in models)
    assert all(m.stages[-1].featureImportances.toArray().argmax() == 0 for m in models)


def test_least_rows_of_a_node_are_counted_in_rows(spark):
    d = rows(spark)
    found = B.cells(d, ["a", "b"], "y", M.build("random_forest", "regression"), 2, False)
    est = M.build("random_forest", "regression").setNumTrees(2)
    deep, flat = (B.fit_cells(found, est.copy().setMinInstancesPerNode(m)) for m in (20, 800))
    assert deep.totalNumNodes > 2 and flat.totalNumNodes == 2
    points = deep.transform(found.points(B.ALL_ROWS)).select("features", "prediction").first()
    assert points.prediction == pytest.approx(np.mean([t.predict(points.features) for t in deep.trees]))


def test_search_scores_are_those_of_the_rows(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    from pyspark.sql import functions as F
    d = rows(spark, 300).where("a is not null").withColumn("__row_index", F.monotonically_increasing_id().cast("string")).cache()
    got = M.sampled_search(d, ["a", "b"], "y", "decision_tree", "regression", {"maxDepth": [2]}, folds=2).first().mean_score
    at = d.join(M.repeated_kfold(d.select("__row_index"), k=2, repeats=1, seed=42).select("__row_index", F.col("fold").alias("f")), "__row_index")
    at = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(at).cache()
    est, judge = M.build("decision_tree", "regression", 42, "y").setMaxDepth(2), RegressionEvaluator(labelCol="y", metricName="r2")
    assert got == pytest.approx(np.mean([judge.evaluate(est.fit(at.where(f"f <> {f}")).transform(at.where(f"f = {f}"))) for f in (0, 1)]))


def test_fit_step_metrics_score_a_row_once(spark):
    from pyspark.sql import functions as F
    calls = spark.sparkContext.accumulator(0)

    def proba(x):
        calls.add(1)
        return x / 10

    rows = spark.range(10).select(F.lit("train").alias("split"), (F.col("id") % 2).cast("double").alias("c"), F.udf(proba, "double")("id").alias("pred_proba"))
    got = M.fit_step_metrics(rows.withColumn("pred_label", (F.col("pred_proba") >= 0.5).cast("int")), "c").first()
    assert got.n == 10 and calls.value == 10
