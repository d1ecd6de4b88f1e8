"""Exact model metrics over prediction tables.

AUROC and average precision are exact with ties: rows are folded to one row
per (group, distinct score) with positive/negative counts, then a skew-safe
running sum over distinct scores (``ranks.running_sum``) gives the counts
below each threshold -- no global sort of the rows and no binning (unlike
``BinaryClassificationEvaluator``'s default 1000 bins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import is_finite, sigmoid
from tessera.operators.ranks import bounded_broadcast, running_sum

ALL = "__all__"


def _grp(by: str | None) -> Column:
    return F.col(by).cast("string") if by else F.lit(ALL)


def score_groups(df: DataFrame, y: str, score: str, by: str | None = None, max_groups: int = 16) -> DataFrame:
    """(grp, s, pos, neg, pos_before, neg_before, P, N, bad) with counts of
    strictly smaller scores inside the group; ``bad`` = rows with a
    non-finite score or label (K5)."""
    base = df.select(_grp(by).alias("grp"), F.col(y).cast("double").alias("__y"), F.col(score).cast("double").alias("s"))
    tot = base.groupBy("grp").agg(
        F.count_if(F.col("__y") == 1).alias("P"), F.count_if(F.col("__y") == 0).alias("N"),
        F.count_if(~is_finite("s") | ~is_finite("__y")).alias("bad"))
    ok = base.filter(is_finite("s") & is_finite("__y"))
    per = ok.groupBy("grp", "s").agg(F.count_if(F.col("__y") == 1).alias("pos"), F.count_if(F.col("__y") == 0).alias("neg"))
    run = running_sum(per, "grp", "s", ["pos", "neg"])
    return run.join(bounded_broadcast(tot, max_groups), "grp")


def auc_ap(df: DataFrame, y: str, score: str, by: str | None = None, max_groups: int = 16) -> DataFrame:
    """K1 + K2 (+ K5): per group AUROC (trapezoid, ties count half) and
    average precision sum_n (R_n - R_{n-1}) P_n over distinct thresholds.
    NULL when a class is missing or any input is non-finite."""
    g = score_groups(df, y, score, by, max_groups=max_groups)
    tp = F.col("P") - F.col("pos_before")
    fp = F.col("N") - F.col("neg_before")
    res = g.groupBy("grp").agg(
        F.first("P").alias("P"), F.first("N").alias("N"), F.first("bad").alias("bad"),
        F.sum(F.col("pos").cast("double") * (F.col("neg_before") + 0.5 * F.col("neg"))).alias("__auc_num"),
        F.sum(F.when(F.col("pos") > 0, F.col("pos").cast("double") * tp / (tp + fp))).alias("__ap_num"))
    valid = (F.col("P") > 0) & (F.col("N") > 0) & (F.col("bad") == 0)
    return res.select(
        F.col("grp").alias(by or "group"), (F.col("P") + F.col("N")).alias("n"),
        F.when(valid, F.col("__auc_num") / (F.col("P").cast("double") * F.col("N"))).alias("auc"),
        F.when(valid, F.col("__ap_num") / F.col("P")).alias("auprc"))


def classification_counts(df: DataFrame, y: str, pred: str, by: str | None = None) -> DataFrame:
    """K3: tp/fp/fn/tn, accuracy, F1 of class 1 (0/0 -> 0) in one aggregate."""
    yt, yp = F.col(y).cast("int"), F.col(pred).cast("int")
    g = df.groupBy(_grp(by).alias(by or "group")).agg(
        F.count_if((yt == 1) & (yp == 1)).alias("tp"), F.count_if((yt == 0) & (yp == 1)).alias("fp"),
        F.count_if((yt == 1) & (yp == 0)).alias("fn"), F.count_if((yt == 0) & (yp == 0)).alias("tn"))
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    denom = 2 * F.col("tp") + F.col("fp") + F.col("fn")
    return g.select("*", ((F.col("tp") + F.col("tn")) / n).alias("accuracy"),
                    F.when(denom == 0, F.lit(0.0)).otherwise(2 * F.col("tp") / denom).alias("f1"))


def input_problems(df: DataFrame, cols: list[str]) -> DataFrame:
    """K5: per column of metric inputs the cells that are missing and those that
    are not finite, in one aggregate (column, n, n_missing, n_non_finite)."""
    def stats(i: int, c: str) -> list[Column]:
        number = F.col(f"`{c}`").cast("string").try_cast("double")
        return [F.count_if(number.isNull()).alias(f"m{i}"), F.count_if(number.isNotNull() & ~is_finite(number)).alias(f"f{i}")]

    counts = df.agg(F.count(F.lit(1)).alias("n"), *[s for i, c in enumerate(cols) for s in stats(i, c)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("n"), F.col(f"m{i}").alias("n_missing"), F.col(f"f{i}").alias("n_non_finite"))
        for i, c in enumerate(cols)])))


def checked_inputs(df: DataFrame, y: str, pred: str, context: str = "metrics") -> DataFrame:
    """K5, error mode: the table, if targets and predictions are all finite
    numbers; else ValueError with the cells that are not."""
    bad = [r for r in input_problems(df, [y, pred]).collect() if r["n_missing"] + r["n_non_finite"]]
    if bad:
        raise ValueError(f"{context}: " + "; ".join(
            f"{r['column']}: {r['n_missing']} of {r['n']} missing, {r['n_non_finite']} not finite" for r in bad))
    return df


def regression_metrics(df: DataFrame, y: str, pred: str, by: str | None = None) -> DataFrame:
    """K4 (+ K5): R^2 = 1 - SSE/SST (constant target: 1 if perfect else 0),
    MAE; NULL when any input is non-finite."""
    yt, yp = F.col(y).cast("double"), F.col(pred).cast("double")
    g = df.groupBy(_grp(by).alias(by or "group")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~is_finite(yt) | ~is_finite(yp)).alias("bad"),
        F.sum((yt - yp) * (yt - yp)).alias("sse"), (F.var_pop(yt) * F.count(yt)).alias("sst"),
        F.avg(F.abs(yt - yp)).alias("mae"))
    r2 = F.when(F.col("sst") == 0, F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
        .otherwise(1 - F.col("sse") / F.col("sst"))
    ok = F.col("bad") == 0
    return g.select(F.col(by or "group"), "n", F.when(ok, r2).alias("r2"), F.when(ok, F.col("mae")).alias("mae"))


def roc_points(df: DataFrame, y: str, score: str, by: str | None = None) -> DataFrame:
    """K6: (threshold, fpr, tpr) per distinct score (desc), plus (0, 0)."""
    g = score_groups(df, y, score, by)
    pts = g.select("grp", F.col("s").alias("threshold"),
                   ((F.col("N") - F.col("neg_before")) / F.col("N")).alias("fpr"),
                   ((F.col("P") - F.col("pos_before")) / F.col("P")).alias("tpr"))
    start = g.select("grp").distinct().select("grp", F.lit(float("inf")).alias("threshold"),
                                              F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start).withColumnRenamed("grp", by or "group")


def pr_points(df: DataFrame, y: str, score: str, by: str | None = None) -> DataFrame:
    """K7: precision/recall per distinct threshold down to the first one
    reaching full recall, the end point (precision 1, recall 0), and the
    prevalence."""
    g = score_groups(df, y, score, by)
    tp = F.col("P") - F.col("pos_before")
    fp = F.col("N") - F.col("neg_before")
    min_pos = g.filter(F.col("pos") > 0).groupBy("grp").agg(F.min("s").alias("min_pos"))
    pts = g.join(min_pos, "grp").filter(F.col("s") >= F.col("min_pos")).select(
        "grp", F.col("s").alias("threshold"), (tp / (tp + fp)).alias("precision"), (tp / F.col("P")).alias("recall"),
        (F.col("P") / (F.col("P") + F.col("N"))).alias("prevalence"))
    end = g.groupBy("grp").agg(F.first(F.col("P") / (F.col("P") + F.col("N"))).alias("prevalence")).select(
        "grp", F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"), "prevalence")
    return pts.unionByName(end).withColumnRenamed("grp", by or "group")


def confusion_matrix(df: DataFrame, y: str, pred: str) -> DataFrame:
    """K8: all four cells, zeros kept (cells from a literal table)."""
    counts = df.groupBy(F.col(y).cast("int").alias("y_true"), F.col(pred).cast("int").alias("y_pred")).count()
    cells = df.sparkSession.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "y_true int, y_pred int")
    return cells.join(counts, ["y_true", "y_pred"], "left").select(
        "y_true", "y_pred", F.coalesce("count", F.lit(0)).alias("count"))


def classification_outputs(df: DataFrame, proba: str | None = None, score: str | None = None,
                           label: str | None = None, threshold: float = 0.5) -> DataFrame:
    """M9: pred_proba from a probability, else sigmoid(score), else the hard
    label; pred_label = proba >= threshold; non-finite outputs raise."""
    if proba:
        p = F.col(proba).cast("double")
    elif score:
        p = sigmoid(F.col(score).cast("double"))
    else:
        p = F.col(label).cast("double")
    p = F.when(is_finite(p), p).otherwise(F.raise_error(F.lit("non-finite classifier output")))
    out = df.withColumn("pred_proba", p)
    out = out.withColumn("pred_score", F.col(score).cast("double") if score else F.col("pred_proba"))
    return out.withColumn("pred_label", (F.col("pred_proba") >= threshold).cast("int"))


def parity_table(df: DataFrame, y: str, pred: str, by: str) -> DataFrame:
    """How many finite (y, y_hat) pairs per split plus 'all' (``rollup``),
    with axis limits min/max -+ 5 % of the span (or -+1 when the span is 0).
    ``parity_pairs`` gives the pairs."""
    ok = df.filter(is_finite(y) & is_finite(pred))
    g = ok.rollup(by).agg(F.count(F.lit(1)).alias("n"), F.least(F.min(y), F.min(pred)).alias("lo"),
                          F.greatest(F.max(y), F.max(pred)).alias("hi"))
    span = F.col("hi") - F.col("lo")
    pad = F.when(span == 0, F.lit(1.0)).otherwise(0.05 * span)
    return g.select(F.coalesce(F.col(by).cast("string"), F.lit("all")).alias(by), "n",
                    (F.col("lo") - pad).alias("axis_min"), (F.col("hi") + pad).alias("axis_max"))


def parity_pairs(df: DataFrame, y: str, pred: str, by: str) -> DataFrame:
    """The finite (y, y_hat) pairs, each once for its split and once for 'all'."""
    ok = df.filter(is_finite(y) & is_finite(pred))
    parts = F.array(F.col(by).cast("string"), F.lit("all"))
    return ok.select(F.explode(parts).alias(by), F.col(y).alias("y"), F.col(pred).alias("y_hat"))
