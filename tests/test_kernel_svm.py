"""RBF support vectors on shapes that no linear model fits."""

import numpy as np
import pytest

from tessera.operators.kernel_svm import fit_kernel_svm


def table(spark, x, y):
    return spark.createDataFrame([(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y))], "id long, a double, `b c` double, y double").repartition(5)


def test_circles(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 2, (1200, 2))
    y = (x**2).sum(1) < 1.6
    model = fit_kernel_svm(table(spark, x[:900], y[:900]), ["a", "b c"], "y", "classification", components=128)
    out = model.score(table(spark, x[900:], y[900:]))
    assert out.columns == ["id", "a", "b c", "y", "pred_proba", "pred_score", "pred_label"]
    rows = out.collect()
    assert np.mean([r.pred_label == r.y for r in rows]) > 0.95
    assert all((r.pred_proba >= 0.5) == bool(r.pred_label) for r in rows)
    again = fit_kernel_svm(table(spark, x[:900], y[:900]).repartition(2), ["a", "b c"], "y", "classification", components=128)
    assert np.allclose(model.weight, again.weight, atol=1e-4)


def test_sine(spark):
    rng = np.random.default_rng(2)
    x = rng.uniform(-3, 3, (800, 2))
    y = np.sin(2 * x[:, 0]) + 0.02 * rng.normal(size=800)
    model = fit_kernel_svm(table(spark, x, y), ["a"], "y", "regression", gamma=1.0, c=10.0, epsilon=0.05)
    rows = model.score(table(spark, x, y)).collect()
    assert max(abs(r.pred_0 - np.sin(2 * r.a)) for r in rows) < 0.2
    assert np.corrcoef([r.pred_0 for r in rows], [r.y for r in rows])[0, 1] > 0.99


def test_missing_values(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 1.0), (float("nan"), 1.0), (2.0, 1.0), (3.0, None)], "a double, y double")
    model = fit_kernel_svm(df, ["a"], "y", "regression", components=16)
    assert [r.pred_0 is None for r in model.score(df).collect()] == [False, True, True, False, False]
    with pytest.raises(ValueError):
        fit_kernel_svm(df.limit(0), ["a"], "y", "regression")
