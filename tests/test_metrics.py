import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import metrics as K


def _auc_bruteforce(y, s):
    pos = [b for a, b in zip(y, s) if a == 1]
    neg = [b for a, b in zip(y, s) if a == 0]
    tot = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def _ap_bruteforce(y, s):
    P = sum(y)
    ap = 0.0
    for t in sorted(set(s), reverse=True):
        tp = sum(1 for a, b in zip(y, s) if b >= t and a == 1)
        fp = sum(1 for a, b in zip(y, s) if b >= t and a == 0)
        pos_here = sum(1 for a, b in zip(y, s) if b == t and a == 1)
        ap += pos_here / P * tp / (tp + fp)
    return ap


def test_auc_ap_with_ties(spark):
    rng = random.Random(3)
    y = [rng.randint(0, 1) for _ in range(300)]
    s = [round(rng.random() * 0.5 + 0.3 * a, 1) for a in y]
    df = spark.createDataFrame(list(zip(y, s)), "y int, s double")
    r = K.auc_ap(df, "y", "s").first()
    assert r.auc == pytest.approx(_auc_bruteforce(y, s))
    assert r.auprc == pytest.approx(_ap_bruteforce(y, s))


def test_auc_null_for_one_class_or_nan(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert K.auc_ap(one, "y", "s").first().auc is None
    bad = spark.createDataFrame([(1, 0.2), (0, float("nan"))], "y int, s double")
    assert K.auc_ap(bad, "y", "s").first().auc is None


def test_f1_zero_division_and_r2_constant(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = K.classification_counts(df, "y", "p").first()
    assert r.f1 == 0.0 and r.accuracy == 1.0
    c = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert K.regression_metrics(c, "y", "p").first().r2 == 1.0
    c2 = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y double, p double")
    assert K.regression_metrics(c2, "y", "p").first().r2 == 0.0


def test_confusion_matrix_keeps_zero_cells(spark):
    df = spark.createDataFrame([(1, 1), (1, 1)], "y int, p int")
    cells = {(r.y_true, r.y_pred): r["count"] for r in K.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 2}


def test_classification_outputs_sigmoid(spark):
    df = spark.createDataFrame([(0.0,), (2.0,)], "m double")
    out = K.classification_outputs(df, score="m").orderBy("m").collect()
    assert out[0].pred_proba == pytest.approx(0.5) and out[0].pred_label == 1
    assert out[1].pred_proba == pytest.approx(1 / (1 + 2.718281828459045 ** -2))


def test_parity_pairs_and_fit_step_metrics(spark):
    from tessera.operators import metrics as K
    from tessera.operators import models as M

    nan = float("nan")
    pairs = spark.createDataFrame([("train", 1.0, 2.0), ("train", nan, 1.0), ("test", 3.0, 4.0)], "split string, y double, p double")
    got = sorted(tuple(r) for r in K.parity_pairs(pairs, "y", "p", "split").collect())
    assert got == [("all", 1.0, 2.0), ("all", 3.0, 4.0), ("test", 3.0, 4.0), ("train", 1.0, 2.0)]

    rows = [("test", 1, 0.9, 1), ("test", 1, 0.4, 0), ("test", 0, 0.6, 1), ("test", 0, 0.1, 0), ("test", 1, 0.8, 1)]
    scored = spark.createDataFrame(rows, "split string, label int, pred_proba double, pred_label int")
    r = M.fit_step_metrics(scored, "label").first().asDict()
    assert round(r["accuracy"], 6) == 0.6 and round(r["f1"], 6) == 0.666667 and {"auc", "auprc"} <= set(r)
