"""Rows with their folds, stored once for all fits."""

from types import SimpleNamespace

import pytest
from pyspark.ml.linalg import Vectors

from tessera.operators import models as M
from tessera.operators.split import repeated_kfold
from tessera.plans import QUERIES
from tessera.plans import models as P


def test_kept_columns_are_those_of_a_join(spark):
    rows = spark.createDataFrame([(i, i * i) for i in range(101)], "id long, x long")
    folds = repeated_kfold(rows, k=4, repeats=2, id_col="id")
    kept = repeated_kfold(rows, k=4, repeats=2, id_col="id", keep_columns=True)
    assert kept.columns == ["id", "x", "repeat", "fold"]
    assert sorted(kept.collect()) == sorted(rows.join(folds, "id").collect())
    with pytest.raises(ValueError):
        repeated_kfold(rows, id_col="id", label="x", keep_columns=True)


def test_x10_fits_all_folds_on_stored_rows(spark, monkeypatch):
    small = "/root/testdata/sf0.001"
    model = SimpleNamespace(stages=[SimpleNamespace(featureImportances=Vectors.dense([0.1, 0.2, 0.3, 0.4]))])
    seen = []
    monkeypatch.setattr(M, "fit_without_folds", lambda rows, *a, **k: seen.append(rows) or [model] * 5)
    monkeypatch.setattr(M, "fit", lambda *a, **k: pytest.fail("a fit of its own per fold"))
    top = QUERIES["x10_stable_top_k_features"](spark, small).collect()
    assert [r.feature for r in top] == P.CLS_FEATURES[::-1]
    plan = seen[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    per_fold = [r["count"] for r in seen[0].groupBy("fold").count().collect()]
    train = P.model_table(spark, small).where("split = 'train'").count()
    assert len(per_fold) == 5 and max(per_fold) - min(per_fold) <= 1 and sum(per_fold) == train
