"""Bijections, permutation importance, sampled search and the numbered grid."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import bijection
from tessera.operators import grid as G
from tessera.operators import models as M


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000, 4097])
def test_permute_is_a_bijection(n):
    a, b = (bijection.permute(np.arange(n), n, s) for s in (1, 2))
    assert sorted(a.tolist()) == list(range(n)) and (bijection.permute(np.arange(n), n, 1) == a).all()
    assert n < 17 or ((a != b).mean() > 0.8 and (a != np.arange(n)).mean() > 0.8)


def test_draws_are_different_and_repeatable():
    sizes = [3, 4, 5]
    assert bijection.draw(sizes, 20, 9) == bijection.draw(sizes, 20, 9) != bijection.draw(sizes, 20, 10)
    assert len({tuple(x) for x in bijection.draw(sizes, 20, 9)}) == 20
    assert sorted(map(tuple, bijection.draw(sizes, 1000, 9))) == list(itertools.product(*map(range, sizes)))
    assert len(bijection.draw([10**6] * 3, 5, 1)) == 5


def linear_rows(spark, n=600):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, 3))
    y = 5 * x[:, 0] + x[:, 1]
    rows = [(f"r{i}", *map(float, v), float(t), float(t > 0)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "__row_index string, strong double, weak double, noise double, y double, c double")


def test_permutation_importance(spark):
    d = linear_rows(spark)
    names = ["noise", "weak", "strong"]
    model = M.fit(d, names, "y", "random_forest", "regression")
    got = M.permutation_importance(model, d, names, "y", "regression", n_repeats=4).collect()
    assert [r.feature for r in got] == ["strong", "weak", "noise"]
    assert got[0].importance_mean > 0.8 and abs(got[2].importance_mean) < 0.1 and got[0].importance_std > 0
    again = M.permutation_importance(model, d.repartition(7), names, "y", "regression", n_repeats=4).collect()
    assert [r.importance_mean for r in again] == pytest.approx([r.importance_mean for r in got])
    model = M.fit(d, names, "c", "decision_tree", "classification")
    assert M.permutation_importance(model, d, names, "c", "classification", n_repeats=2).first().feature == "strong"


def test_sampled_search(spark):
    d = linear_rows(spark, 200)
    space = {"maxDepth": [1, 6], "minInstancesPerNode": [1, 2, 100]}
    run = lambda **how: M.sampled_search(d, ["strong", "weak"], "y", "decision_tree", "regression", space, **how).collect()
    got = run(n_draws=4, folds=3)
    assert len(got) == 4 and len({tuple(sorted(r.params.items())) for r in got}) == 4
    assert [r.mean_score for r in got] == sorted((r.mean_score for r in got), reverse=True)
    assert [(r.draw, r.params) for r in run(n_draws=4, folds=3)] == [(r.draw, r.params) for r in got]
    every = run(folds=2)  # 100 draws of six settings
    assert len(every) == 6 and every[0].params["maxDepth"] == "6" and every[-1].mean_score < 0.9
    acc = M.sampled_search(d, ["strong", "weak"], "c", "decision_tree", "classification", {"maxDepth": [1, 5]}, folds=2).collect()
    assert all(0.5 < r.mean_score <= 1 for r in acc)
    with pytest.raises(ValueError):
        M.sampled_search(d, ["strong"], "y", "decision_tree", "regression", {"maxDepth": []})


def test_grid_numbers(spark):
    axes = {a: spark.createDataFrame([(v,) for v in vs] + [(None,)], "v string") for a, vs in {"b.x": "qpr", "a": "10", "c": "z"}.items()}
    row = G.axes_row(axes)
    got = G.expand(row, list(axes)).collect()
    want = list(itertools.product("01", "pqr", "z"))
    assert [(r.combo_index, r["a"], r["b.x"], r["c"]) for r in got] == [(i, *w) for i, w in enumerate(want)]
    plan = G.expand(row, list(axes))
    plan = plan.groupBy("a").agg(F.min("combo_index"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan.replace("AdaptiveSparkPlan", "")
    few = G.draw_cases(row, list(axes), 4, seed=5).collect()
    assert sorted(r.draw for r in few) == [0, 1, 2, 3] and len({r.combo_index for r in few}) == 4
    assert all((r["a"], r["b.x"], r["c"]) == want[r.combo_index] for r in few)


def test_summary_and_top(spark):
    runs = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, 2.0), ("b", 5.0, 1.0)], "m string, r2 double, mae double")
    got = {r.m: r for r in M.benchmark_summary(runs, "m", ["r2", "mae"]).collect()}
    assert (got["a"].n_runs, got["a"].r2_mean, got["a"].r2_std, got["a"].mae_mean) == (2, 2.0, 1.0, 2.0)
    t = spark.createDataFrame([("x", 0.1), ("b", 0.5), ("a", 0.5)], "feature string, importance double")
    assert [r.feature for r in M.top_importances(t, 2).collect()] == ["a", "b"]
