"""Metric queries (K1-K11, M9) over a prediction table derived from lineitem:
y_true = (l_returnflag = 'R'), score = floor((0.5*u + 0.3*y) * 100) / 100
with u = md5 hash in [0, 1) of the row id (two-decimal scores force ties);
regression y = l_extendedprice / 1000, y_hat = 1.5 * l_quantity + 5u."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.hashing import hash_unit
from tessera.operators import metrics as K
from tessera.operators.split import random_holdout
from tessera.plans import register
from tessera.plans.splits import _holdout_sql
from tessera.sources.tables import LINEITEM_KEY_SQL, ROW_INDEX, lineitem_rows


def predictions(spark, sf_dir, with_split: bool = False):
    li = lineitem_rows(spark, sf_dir)
    y = (F.col("l_returnflag") == "R").cast("int")
    u = hash_unit(42, ROW_INDEX)
    p = li.select(ROW_INDEX, y.alias("y_true"), (F.floor((0.5 * u + 0.3 * y) * 100) / 100).alias("y_score"),
                  (F.col("l_extendedprice") / 1000).alias("y_reg"), (1.5 * F.col("l_quantity") + 5 * u).alias("y_hat"))
    if with_split:
        p = random_holdout(p, test_size=0.2, val_size=0.1, seed=42, keep_columns=True)
    return p


PRED_SQL = f"""
k AS (SELECT *, {LINEITEM_KEY_SQL} AS rid FROM lineitem),
u AS (SELECT *, ('0x' || substr(md5('42:' || rid), 1, 8))::BIGINT / 4294967296.0 AS u,
             CAST(l_returnflag = 'R' AS INTEGER) AS y FROM k),
p AS (SELECT rid, y AS y_true, floor((0.5 * u + 0.3 * y) * 100) / 100 AS y_score, l_extendedprice / 1000 AS y_reg,
             1.5 * l_quantity + 5 * u AS y_hat FROM u),""" + _holdout_sql("p", "rid", 42, 0.2, 0.1)

SCORE_SQL = """
sg AS (SELECT grp, y_score AS s, count(*) FILTER (WHERE y_true = 1) AS pos, count(*) FILTER (WHERE y_true = 0) AS neg
       FROM src GROUP BY 1, 2),
tot AS (SELECT grp, sum(pos) AS "P", sum(neg) AS "N" FROM sg GROUP BY 1),
run AS (SELECT sg.*, "P", "N",
          coalesce(sum(pos) OVER (PARTITION BY grp ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pb,
          coalesce(sum(neg) OVER (PARTITION BY grp ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM sg JOIN tot USING (grp))"""


@register("k1_k2_auroc_average_precision", "WITH " + PRED_SQL + ", src AS (SELECT '__all__' AS grp, * FROM h),"
          + SCORE_SQL + """
SELECT grp AS "group", CAST(first("P") + first("N") AS BIGINT) AS n,
       round(sum(pos * (nb + 0.5 * neg)) / (first("P") * first("N")), 6) AS auc,
       round(sum(CASE WHEN pos > 0 THEN pos * ("P" - pb) / (("P" - pb) + ("N" - nb)) END) / first("P"), 6) AS auprc
FROM run GROUP BY grp""")
def k1_k2(spark, sf_dir):
    r = K.auc_ap(predictions(spark, sf_dir), "y_true", "y_score")
    return r.select("group", "n", F.round("auc", 6).alias("auc"), F.round("auprc", 6).alias("auprc"))


@register("k3_accuracy_f1", "WITH " + PRED_SQL + """
SELECT count(*) FILTER (WHERE y_true = 1 AND y_score >= 0.5) AS tp, count(*) FILTER (WHERE y_true = 0 AND y_score >= 0.5) AS fp,
       count(*) FILTER (WHERE y_true = 1 AND y_score < 0.5) AS fn, count(*) FILTER (WHERE y_true = 0 AND y_score < 0.5) AS tn,
       round((tp + tn) / count(*), 6) AS accuracy,
       round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 6) AS f1 FROM h""")
def k3(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("y_pred", (F.col("y_score") >= 0.5).cast("int"))
    r = K.classification_counts(p, "y_true", "y_pred")
    return r.select("tp", "fp", "fn", "tn", F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


@register("k4_r2_mae", "WITH " + PRED_SQL + """
SELECT count(*) AS n, round(1 - sum((y_reg - y_hat) * (y_reg - y_hat)) / (var_pop(y_reg) * count(*)), 6) AS r2,
       round(avg(abs(y_reg - y_hat)), 6) AS mae FROM h""")
def k4(spark, sf_dir):
    r = K.regression_metrics(predictions(spark, sf_dir), "y_reg", "y_hat")
    return r.select("n", F.round("r2", 6).alias("r2"), F.round("mae", 6).alias("mae"))


@register("k5_input_problems", """
SELECT 'l_extendedprice' AS column, count(*) AS n, CAST(count_if(l_extendedprice IS NULL) AS BIGINT) AS n_missing, CAST(0 AS BIGINT) AS n_non_finite FROM lineitem
UNION ALL SELECT 'v', count(*), CAST(count_if(l_tax = 0) AS BIGINT), CAST(count_if(l_tax <> 0 AND l_discount = 0) AS BIGINT) FROM lineitem""")
def k5_problems(spark, sf_dir):
    """Predictions missing where the tax is 0 and infinite where the discount is."""
    li = lineitem_rows(spark, sf_dir).withColumn("v", F.when(F.col("l_tax") == 0, F.lit(None))
        .when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.col("l_extendedprice")))
    return K.input_problems(li, ["l_extendedprice", "v"])


@register("k5_input_validation", """
SELECT CAST(sum(CASE WHEN isfinite(v) THEN 0 ELSE 1 END) AS BIGINT) AS n_non_finite, count(*) AS n,
       NULL::DOUBLE AS r2, NULL::DOUBLE AS mae
FROM (SELECT CASE WHEN l_discount = 0 THEN 'nan'::DOUBLE ELSE l_extendedprice END AS v FROM lineitem)""")
def k5(spark, sf_dir):
    """A prediction column with NaN (discount 0 -> NaN) makes R^2/MAE NULL."""
    li = lineitem_rows(spark, sf_dir).withColumn(
        "v", F.when(F.col("l_discount") == 0, F.lit(float("nan"))).otherwise(F.col("l_extendedprice")))
    r = K.regression_metrics(li, "l_extendedprice", "v")
    bad = li.agg(F.count_if(~F.col("v").isNotNull() | F.isnan("v")).cast("long").alias("n_non_finite"))
    return bad.join(r.select("n", "r2", "mae"), how="inner")


@register("k6_roc_points", "WITH " + PRED_SQL + ", src AS (SELECT '__all__' AS grp, * FROM h)," + SCORE_SQL + """
SELECT grp AS "group", s AS threshold, round(("N" - nb) / "N", 6) AS fpr, round(("P" - pb) / "P", 6) AS tpr FROM run
UNION ALL SELECT '__all__', 'inf'::DOUBLE, 0.0, 0.0""")
def k6(spark, sf_dir):
    r = K.roc_points(predictions(spark, sf_dir), "y_true", "y_score")
    return r.select("group", "threshold", F.round("fpr", 6).alias("fpr"), F.round("tpr", 6).alias("tpr"))


@register("k7_pr_points", "WITH " + PRED_SQL + ", src AS (SELECT '__all__' AS grp, * FROM h)," + SCORE_SQL + """
, mp AS (SELECT grp, min(s) AS min_pos FROM run WHERE pos > 0 GROUP BY grp)
SELECT grp AS "group", s AS threshold, round(("P" - pb) / (("P" - pb) + ("N" - nb)), 6) AS precision,
       round(("P" - pb) / "P", 6) AS recall, round("P" / ("P" + "N"), 6) AS prevalence
FROM run JOIN mp USING (grp) WHERE s >= min_pos
UNION ALL SELECT grp, NULL, 1.0, 0.0, round(first("P" / ("P" + "N")), 6) FROM run GROUP BY grp""")
def k7(spark, sf_dir):
    r = K.pr_points(predictions(spark, sf_dir), "y_true", "y_score")
    return r.select("group", "threshold", F.round("precision", 6).alias("precision"),
                    F.round("recall", 6).alias("recall"), F.round("prevalence", 6).alias("prevalence"))


@register("k8_confusion_matrix", "WITH " + PRED_SQL + """
, cells AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) t(y_true, y_pred)),
c AS (SELECT y_true, CAST(y_score >= 0.5 AS INTEGER) AS y_pred, count(*) AS n FROM h GROUP BY 1, 2)
SELECT cells.y_true, cells.y_pred, coalesce(n, 0) AS count FROM cells LEFT JOIN c USING (y_true, y_pred)""")
def k8(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("y_pred", (F.col("y_score") >= 0.5).cast("int"))
    return K.confusion_matrix(p, "y_true", "y_pred")


@register("k9_per_split_metric_table", "WITH " + PRED_SQL + ", src AS (SELECT split AS grp, * FROM h)," + SCORE_SQL + """
, a AS (SELECT grp AS split, round(sum(pos * (nb + 0.5 * neg)) / (first("P") * first("N")), 6) AS auc,
           round(sum(CASE WHEN pos > 0 THEN pos * ("P" - pb) / (("P" - pb) + ("N" - nb)) END) / first("P"), 6) AS auprc
        FROM run GROUP BY grp),
b AS (SELECT split, round(avg(CASE WHEN (y_score >= 0.5) = (y_true = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
             round(1 - sum((y_reg - y_hat) * (y_reg - y_hat)) / (var_pop(y_reg) * count(*)), 6) AS r2,
             round(avg(abs(y_reg - y_hat)), 6) AS mae FROM h GROUP BY split)
SELECT split, metric, value FROM (SELECT * FROM a JOIN b USING (split))
UNPIVOT (value FOR metric IN (auc, auprc, accuracy, r2, mae))""")
def k9(spark, sf_dir):
    p = predictions(spark, sf_dir, with_split=True).withColumn("y_pred", (F.col("y_score") >= 0.5).cast("int"))
    a = K.auc_ap(p, "y_true", "y_score", by="split")
    b = K.classification_counts(p, "y_true", "y_pred", by="split").select("split", "accuracy")
    c = K.regression_metrics(p, "y_reg", "y_hat", by="split").select("split", "r2", "mae")
    wide = a.join(b, "split").join(c, "split")
    metrics = ["auc", "auprc", "accuracy", "r2", "mae"]
    long = wide.select("split", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.round(m, 6).alias("value"))
                                                     for m in metrics])).alias("s")).select("split", "s.*")
    # Metrics that are NULL for every split are dropped (K9).
    return long.filter(F.col("value").isNotNull())


@register("k10_parity_table", "WITH " + PRED_SQL + """
, g AS (SELECT coalesce(split, 'all') AS split, count(*) AS n, least(min(y_reg), min(y_hat)) AS lo,
               greatest(max(y_reg), max(y_hat)) AS hi FROM h WHERE isfinite(y_reg) AND isfinite(y_hat) GROUP BY ROLLUP (split))
SELECT split, n, round(lo - CASE WHEN hi = lo THEN 1.0 ELSE 0.05 * (hi - lo) END, 6) AS axis_min,
       round(hi + CASE WHEN hi = lo THEN 1.0 ELSE 0.05 * (hi - lo) END, 6) AS axis_max FROM g""")
def k10(spark, sf_dir):
    p = predictions(spark, sf_dir, with_split=True)
    r = K.parity_table(p, "y_reg", "y_hat", "split")
    return r.select("split", "n", F.round("axis_min", 6).alias("axis_min"), F.round("axis_max", 6).alias("axis_max"))


@register("k9_per_split_metric_table_with_f1", "WITH " + PRED_SQL + ", src AS (SELECT split AS grp, * FROM h)," + SCORE_SQL + """
, a AS (SELECT grp AS split, round(sum(pos * (nb + 0.5 * neg)) / (first("P") * first("N")), 6) AS auc,
           round(sum(CASE WHEN pos > 0 THEN pos * ("P" - pb) / (("P" - pb) + ("N" - nb)) END) / first("P"), 6) AS auprc
        FROM run GROUP BY grp),
b AS (SELECT split, round(avg(CASE WHEN (y_score >= 0.5) = (y_true = 1) THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
             round(coalesce(2.0 * count(*) FILTER (WHERE y_true = 1 AND y_score >= 0.5)
               / nullif(count(*) FILTER (WHERE y_true = 1) + count(*) FILTER (WHERE y_score >= 0.5), 0), 0.0), 6) AS f1,
             round(1 - sum((y_reg - y_hat) * (y_reg - y_hat)) / (var_pop(y_reg) * count(*)), 6) AS r2,
             round(avg(abs(y_reg - y_hat)), 6) AS mae FROM h GROUP BY split)
SELECT split, metric, value FROM (SELECT * FROM a JOIN b USING (split))
UNPIVOT (value FOR metric IN (auc, auprc, accuracy, f1, r2, mae))""")
def k9_f1(spark, sf_dir):
    p = predictions(spark, sf_dir, with_split=True).withColumn("y_pred", (F.col("y_score") >= 0.5).cast("int"))
    a = K.auc_ap(p, "y_true", "y_score", by="split")
    b = K.classification_counts(p, "y_true", "y_pred", by="split").select("split", "accuracy", "f1")
    c = K.regression_metrics(p, "y_reg", "y_hat", by="split").select("split", "r2", "mae")
    wide = a.join(b, "split").join(c, "split")
    metrics = ["auc", "auprc", "accuracy", "f1", "r2", "mae"]
    long = wide.select("split", F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.round(m, 6).alias("value"))
                                                     for m in metrics])).alias("s")).select("split", "s.*")
    return long.filter(F.col("value").isNotNull())


@register("k10_parity_pairs", "WITH " + PRED_SQL + """
, ok AS (SELECT split, round(y_reg, 6) AS y, round(y_hat, 6) AS y_hat FROM h WHERE isfinite(y_reg) AND isfinite(y_hat))
SELECT split, y, y_hat FROM ok UNION ALL SELECT 'all', y, y_hat FROM ok""")
def k10_pairs(spark, sf_dir):
    r = K.parity_pairs(predictions(spark, sf_dir, with_split=True), "y_reg", "y_hat", "split")
    return r.select("split", F.round("y", 6).alias("y"), F.round("y_hat", 6).alias("y_hat"))


@register("k11_m9_prediction_table", "WITH " + PRED_SQL + """
SELECT rid AS __row_index, y_true, y_score, round(1 / (1 + exp(-(4 * y_score - 2))), 6) AS y_proba,
       CAST(1 / (1 + exp(-(4 * y_score - 2))) >= 0.5 AS INTEGER) AS y_pred FROM h""")
def k11(spark, sf_dir):
    p = predictions(spark, sf_dir).withColumn("logit", 4 * F.col("y_score") - 2)
    out = K.classification_outputs(p, score="logit")
    return out.select(ROW_INDEX, "y_true", "y_score", F.round("pred_proba", 6).alias("y_proba"),
                      F.col("pred_label").alias("y_pred"))
