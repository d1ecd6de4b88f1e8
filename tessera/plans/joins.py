"""Join / alignment queries (J1-J7, J14, J15) and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import align as A
from tessera.operators.split import random_holdout
from tessera.plans import register
from tessera.sources.tables import LINEITEM_KEY_SQL, ROW_INDEX, lineitem_rows, table


@register("j1_feature_label_alignment", """
SELECT l_returnflag, count(*) AS n_rows, round(sum(l_quantity), 6) AS sum_qty FROM lineitem GROUP BY 1""")
def j1(spark, sf_dir):
    li = lineitem_rows(spark, sf_dir)
    X = li.select(ROW_INDEX, "l_quantity", "l_extendedprice", "l_returnflag")
    y = li.select(ROW_INDEX, "l_returnflag")
    aligned = A.align_features_labels(X, y, "l_returnflag", check_counts=True)
    return aligned.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n_rows"),
                                               F.round(F.sum("l_quantity"), 6).alias("sum_qty"))


@register("j2_restrict_to_ids", """
WITH ids AS (SELECT o_orderkey AS __row_index FROM orders WHERE o_orderpriority = '1-URGENT'),
li AS (SELECT l_orderkey AS __row_index, l_quantity FROM lineitem)
SELECT (SELECT count(*) FROM li WHERE __row_index IN (SELECT __row_index FROM ids)) AS n_rows,
       (SELECT count(*) FROM ids WHERE __row_index NOT IN (SELECT __row_index FROM li)) AS n_missing_ids""")
def j2(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_orderkey").alias(ROW_INDEX))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias(ROW_INDEX), "l_quantity")
    kept = A.restrict_to_ids(li, ids)
    miss = A.missing_ids(ids, li)
    return kept.agg(F.count(F.lit(1)).alias("n_rows")).join(
        miss.agg(F.count(F.lit(1)).alias("n_missing_ids")), how="inner")


@register("j3_universe_check", """
SELECT count(*) AS n_outside_universe FROM (
  SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0))""")
def j3(spark, sf_dir):
    cleaned = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias(ROW_INDEX))
    curated = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias(ROW_INDEX))
    return A.missing_ids(cleaned, curated).agg(F.count(F.lit(1)).alias("n_outside_universe"))


@register("j4_eligible_row_alignment", """
SELECT c.c_mktsegment, count(*) AS n_rows FROM customer c
WHERE c.c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1""")
def j4(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    elig = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F").select(
        F.col("o_custkey").alias("c_custkey")).distinct()
    aligned = cust.join(elig, on="c_custkey", how="inner")
    return aligned.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_rows"))


@register("j5_leakage_row_overlap", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || {LINEITEM_KEY_SQL}), {LINEITEM_KEY_SQL}) AS rn,
                  count(*) OVER () AS n FROM lineitem),
s AS (SELECT *, CASE WHEN rn <= ceil(0.2::DOUBLE * n) THEN 'test' ELSE 'train' END AS split FROM r),
tr AS (SELECT DISTINCT l_quantity, l_discount, l_tax FROM s WHERE split = 'train')
SELECT count(*) AS n_overlapping_test_rows FROM s
WHERE split = 'test' AND EXISTS (SELECT 1 FROM tr WHERE tr.l_quantity IS NOT DISTINCT FROM s.l_quantity
  AND tr.l_discount IS NOT DISTINCT FROM s.l_discount AND tr.l_tax IS NOT DISTINCT FROM s.l_tax)""")
def j5(spark, sf_dir):
    li = lineitem_rows(spark, sf_dir).select(ROW_INDEX, "l_quantity", "l_discount", "l_tax")
    sp = random_holdout(li, test_size=0.2, val_size=0.0, seed=42)
    feat = li.join(sp, on=ROW_INDEX)
    cols = ["l_quantity", "l_discount", "l_tax"]
    train = feat.filter(F.col("split") == "train").select(*cols)
    test = feat.filter(F.col("split") == "test").select(*cols)
    return A.row_overlap(train, test, cols).agg(F.count(F.lit(1)).alias("n_overlapping_test_rows"))


@register("j6_nth_occurrence_join", """
WITH l AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS occ
           FROM events WHERE dayofmonth(ts) <= 15),
r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS occ
      FROM events WHERE dayofmonth(ts) > 15)
SELECT l.event_type, count(r.event_id) AS n_matched, count(*) - count(r.event_id) AS n_unmatched,
       CAST(sum(r.event_id - l.event_id) AS BIGINT) AS sum_gap
FROM l LEFT JOIN r ON l.event_type = r.event_type AND l.occ = r.occ GROUP BY 1""")
def j6(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_type", "event_id", "ts")
    left = e.filter(F.dayofmonth("ts") <= 15).drop("ts")
    right = e.filter(F.dayofmonth("ts") > 15).drop("ts")
    j = A.nth_occurrence_join(left, right, "event_type", "event_id", "event_id", how="left")
    return j.groupBy("event_type").agg(
        F.count("r_event_id").alias("n_matched"),
        (F.count(F.lit(1)) - F.count("r_event_id")).alias("n_unmatched"),
        F.sum(F.col("r_event_id") - F.col("event_id")).cast("long").alias("sum_gap"))


@register("j7_split_id_mapping", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY md5('7:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS rn,
                  count(*) OVER () AS n FROM orders),
s AS (SELECT o_orderkey AS __row_index, CASE WHEN rn <= ceil(0.2::DOUBLE * n) THEN 'test'
        WHEN rn <= ceil(0.2::DOUBLE * n) + ceil((0.1::DOUBLE / (1 - 0.2::DOUBLE)) * (n - ceil(0.2::DOUBLE * n)))
        THEN 'val' ELSE 'train' END AS split FROM r)
SELECT s.split, count(l.l_orderkey) AS n_rows, count(DISTINCT s.__row_index) FILTER (WHERE l.l_orderkey IS NULL)
       AS n_unmatched_ids
FROM s LEFT JOIN lineitem l ON l.l_orderkey = s.__row_index GROUP BY 1""")
def j7(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias(ROW_INDEX))
    sp = random_holdout(o, test_size=0.2, val_size=0.1, seed=7)
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias(ROW_INDEX), F.lit(1).alias("__hit"))
    j = sp.join(li, on=ROW_INDEX, how="left")
    return j.groupBy("split").agg(
        F.count("__hit").alias("n_rows"),
        F.count_distinct(F.when(F.col("__hit").isNull(), F.col(ROW_INDEX))).alias("n_unmatched_ids"))


@register("j14_resume_anti_join", """
SELECT lang, count(*) AS n_unprocessed, CAST(sum(n_chars) AS BIGINT) AS chars
FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) GROUP BY 1""")
def j14(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    done = table(spark, sf_dir, "labels").select("doc_id")
    todo = docs.join(done, on="doc_id", how="left_anti")
    return todo.groupBy("lang").agg(F.count(F.lit(1)).alias("n_unprocessed"), F.sum("n_chars").cast("long").alias("chars"))


@register("j15_attach_labels", """
SELECT l.quality, count(*) AS n_rows, round(avg(d.n_chars), 6) AS mean_chars
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""")
def j15(spark, sf_dir):
    feats = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = feats.join(labels, on="doc_id", how="inner")
    return j.groupBy("quality").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("n_chars"), 6).alias("mean_chars"))


# ------------------------------------------------------------------ set ops


@register("u1_union_by_name", """
SELECT kind, count(*) AS n_rows, count(acctbal) AS n_with_balance, count(segment) AS n_with_segment FROM (
  SELECT 'customer' AS kind, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment FROM customer
  UNION ALL SELECT 'supplier', s_name, s_acctbal, NULL FROM supplier
  UNION ALL SELECT 'part', p_name, NULL, NULL FROM part) GROUP BY 1""")
def u1(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"),
                                                F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"),
                                                F.col("s_acctbal").alias("acctbal"))
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.lit("part").alias("kind"))
    u = A.union_by_name(c, s, p)
    return u.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"), F.count("acctbal").alias("n_with_balance"),
                                 F.count("segment").alias("n_with_segment"))


@register("u2_intersect", """
SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'""")
def u2(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderstatus") == "F").select("o_custkey").intersect(
        o.filter(F.col("o_orderstatus") == "O").select("o_custkey"))


@register("u3_except", """
SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders""")
def u3(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey").join(
        table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), on="c_custkey", how="left_anti"
    ).distinct()


@register("u4_set_union", """
SELECT k FROM (SELECT c_custkey AS k FROM customer UNION SELECT o_custkey FROM orders) ORDER BY k""")
def u4(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k"))
    return c.union(o).distinct().orderBy("k")


@register("o1_top_k_by_value", """
SELECT o_custkey, round(sum(o_totalprice), 6) AS total FROM orders GROUP BY 1 ORDER BY total DESC, o_custkey LIMIT 20""")
def o1(spark, sf_dir):
    """Top-k report: the limit is the feature (TakeOrderedAndProject)."""
    t = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 6).alias("total"))
    return t.orderBy(F.desc("total"), "o_custkey").limit(20)


@register("o2_multi_key_sort", """
SELECT o_orderstatus, o_orderpriority, o_orderkey FROM orders ORDER BY 1, 2, 3""")
def o2(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey").orderBy(
        "o_orderstatus", "o_orderpriority", "o_orderkey")


@register("o3_preview_limit", """
SELECT rid FROM (SELECT l_orderkey * 10 + l_linenumber AS rid FROM lineitem GROUP BY 1 HAVING count(*) > 1)
ORDER BY rid LIMIT 10""")
def o3(spark, sf_dir):
    """First 10 offending ids for an error message; limit is the feature."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("rid"))
    return li.groupBy("rid").count().filter(F.col("count") > 1).select("rid").orderBy("rid").limit(10)
