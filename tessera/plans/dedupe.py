"""Dedupe queries (D1-D8): events as raw activity rows.

Key = ``user_id * 100 + day of month`` (a user's events of one day, about two
rows per key, so some keys conflict and some do not), label = ``event_type``,
order = ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import checks
from tessera.operators import dedupe as D
from tessera.plans import register
from tessera.sources.tables import LINEITEM_KEY_SQL, ROW_INDEX, events_rows, lineitem_rows, table


def _keyed(spark, sf_dir):
    e = events_rows(spark, sf_dir)
    return e.select(ROW_INDEX, (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("key"), "event_type", "value")


KEYED_SQL = """k AS (SELECT event_id AS __row_index, user_id * 100 + dayofmonth(ts) AS key, event_type, value
                   FROM events)"""


@register("d1_keep_first", f"""
WITH {KEYED_SQL}
SELECT __row_index, key, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY __row_index) AS rn FROM k) WHERE rn = 1""")
def d1_first(spark, sf_dir):
    return D.dedupe(_keyed(spark, sf_dir), "key", "keep_first")


@register("d1_keep_last", f"""
WITH {KEYED_SQL}
SELECT __row_index, key, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY __row_index DESC) AS rn FROM k) WHERE rn = 1""")
def d1_last(spark, sf_dir):
    return D.dedupe(_keyed(spark, sf_dir), "key", "last")


@register("d2_drop_conflicts", f"""
WITH {KEYED_SQL},
s AS (SELECT key, count(DISTINCT event_type) AS nl, min(__row_index) AS first_id FROM k GROUP BY key)
SELECT k.__row_index, k.key, k.event_type, k.value FROM k JOIN s ON k.__row_index = s.first_id WHERE s.nl <= 1""")
def d2(spark, sf_dir):
    return D.dedupe(_keyed(spark, sf_dir), "key", "drop_conflicts", label="event_type")


@register("d3_majority", f"""
WITH {KEYED_SQL},
bl AS (SELECT key, event_type AS l, count(*) AS n, min(__row_index) AS first_id FROM k GROUP BY 1, 2),
pk AS (SELECT key, count(l) AS nl, max(CASE WHEN l IS NOT NULL THEN n END) AS top, min(first_id) AS first_any
       FROM bl GROUP BY key),
win AS (SELECT bl.key, count(*) AS ntop, min(bl.first_id) AS win_id FROM bl JOIN pk ON bl.key = pk.key
        WHERE pk.nl > 1 AND bl.l IS NOT NULL AND bl.n = pk.top GROUP BY bl.key),
pick AS (SELECT CASE WHEN pk.nl <= 1 THEN pk.first_any WHEN win.ntop = 1 THEN win.win_id END AS id
         FROM pk LEFT JOIN win ON pk.key = win.key)
SELECT k.__row_index, k.key, k.event_type, k.value FROM k JOIN pick ON k.__row_index = pick.id""")
def d3(spark, sf_dir):
    return D.dedupe(_keyed(spark, sf_dir), "key", "majority", label="event_type")


@register("d4_conflict_strategy_without_label", f"""
WITH {KEYED_SQL}
SELECT __row_index, key, value FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY __row_index) AS rn FROM k) WHERE rn = 1""")
def d4(spark, sf_dir):
    return D.dedupe(_keyed(spark, sf_dir).drop("event_type"), "key", "majority", label="event_type")


@register("d5_full_row_distinct", """
SELECT DISTINCT * FROM customer""")
def d5(spark, sf_dir):
    return D.distinct_rows(table(spark, sf_dir, "customer"))


@register("d5_full_row_distinct_after_union", """
SELECT DISTINCT * FROM (SELECT * FROM lineitem WHERE l_linenumber <= 5
                        UNION ALL SELECT * FROM lineitem WHERE l_linenumber >= 3)""")
def d5_union(spark, sf_dir):
    """The parts overlap, so that the union has duplicates to remove."""
    li = table(spark, sf_dir, "lineitem")
    return D.distinct_rows(li.where("l_linenumber <= 5").unionByName(li.where("l_linenumber >= 3")))


@register("d6_duplicate_feature_rows", """
WITH g AS (SELECT l_quantity, l_discount, l_tax, l_returnflag, count(*) AS n
           FROM lineitem GROUP BY ALL)
SELECT count(*) AS n_kept, CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
       count(*) FILTER (WHERE n > 1) AS n_duplicated_groups FROM g""")
def d6(spark, sf_dir):
    li = lineitem_rows(spark, sf_dir)
    g = D.duplicate_feature_rows(li, ["l_quantity", "l_discount", "l_tax", "l_returnflag"])
    return g.agg(F.count(F.lit(1)).alias("n_kept"), F.sum(F.col("__n") - 1).cast("long").alias("n_duplicates"),
                 F.count_if(F.col("__n") > 1).cast("long").alias("n_duplicated_groups"))


@register("d6_first_of_equal_feature_rows", f"""
SELECT rid AS __row_index, l_quantity, l_discount, l_tax, l_returnflag FROM (
  SELECT *, row_number() OVER (PARTITION BY l_quantity, l_discount, l_tax, l_returnflag ORDER BY rid) AS rn
  FROM (SELECT {LINEITEM_KEY_SQL} AS rid, * FROM lineitem)) WHERE rn = 1""")
def d6_rows(spark, sf_dir):
    values = ["l_quantity", "l_discount", "l_tax", "l_returnflag"]
    return checks.distinct_feature_rows(lineitem_rows(spark, sf_dir).select(ROW_INDEX, *values), values)


@register("d7_config_hash_dedupe", """
WITH h AS (SELECT o_orderkey, md5(o_orderstatus || '|' || o_orderpriority) AS config_hash, 'valid' AS status
           FROM orders),
f AS (SELECT config_hash, min(o_orderkey) AS first_key FROM h GROUP BY 1)
SELECT CASE WHEN h.o_orderkey <> f.first_key THEN 'skipped' ELSE h.status END AS status,
       CASE WHEN h.o_orderkey <> f.first_key THEN 'DOE_DUPLICATE_CONFIG' END AS duplicate_code,
       count(*) AS n_rows
FROM h JOIN f USING (config_hash) GROUP BY ALL""")
def d7(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.md5(F.concat_ws("|", "o_orderstatus", "o_orderpriority")).alias("config_hash"),
        F.lit("valid").alias("status"))
    out = D.config_hash_dedupe(o, "config_hash", "o_orderkey")
    return out.groupBy("status", "duplicate_code").agg(F.count(F.lit(1)).alias("n_rows"))


@register("d8_first_occurrence_list", """
WITH f AS (SELECT user_id, event_type, min(event_id) AS o FROM events GROUP BY ALL)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY o) AS position, event_type FROM f""")
def d8(spark, sf_dir):
    return D.first_occurrence_distinct(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")
